"""Written tables in the cluster's shared folder and reading of the input tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.session import discard, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def released() -> None:
    """Gives memory that a worker has freed back to the machine; workers live on and are many."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches, after which the worker keeps no more memory than it needs."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            released()

    return run


#: Bits of a sieve: so many for each key, and at most.
KEY_BITS, SIEVE_BITS = 16, 1 << 26


def sieve(keys: DataFrame, rows: int) -> Callable[[Column], Column]:
    """A test of hashes: true for every one in ``keys`` (a long column ``key``, about ``rows`` of them), false for most others.

    Rows that fail it meet nothing in a join with the keys, so they need no
    shuffle. Only bits go to the driver and the tasks: 8 MB at most, whatever
    the keys; more keys than fit let more of the others through.
    """
    bits = min(SIEVE_BITS, 1 << max(10, (KEY_BITS * rows - 1).bit_length()))
    bit = F.pmod("key", F.lit(bits))
    found = keys.groupBy(F.floor(bit / 64).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(key, {bits}) % 64 AS INT))")).alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy()
    sent = keys.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    @F.pandas_udf("boolean")
    def passes(key: pd.Series) -> pd.Series:
        at = key.to_numpy().view(np.uint64) % np.uint64(bits)
        return pd.Series((sent.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool))

    return passes


def connected(edges: DataFrame, name: str = "labels") -> DataFrame:
    """node, label of every node of the undirected ``edges`` (a, b): equal labels for connected nodes.

    Each round joins every node to the neighbour (or itself) that comes first
    in an order drawn anew, and goes on with the joined nodes' edges, so the
    rounds grow with the logarithm of the longest path. Maps of all rounds are
    tables, deleted after use; nothing goes to the driver.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), name)
    size = edges.count()
    labels = stored(edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct().withColumn("label", F.col("node")), name, 2 * size)
    nodes, turn = labels.count(), 0
    while size:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), F.col(c).alias("node"))  # noqa: B023, E731
        first = both.groupBy("a").agg(F.min(rank("b")).alias("near")).select(F.col("a").alias("node"), F.least(rank("a"), "near")["node"].alias("to"))
        first = stored(first, name, min(nodes, 2 * size))
        to = lambda c: first.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))  # noqa: B023, E731
        named = stored(labels.join(to("label"), "label", "left").select("node", F.coalesce("label_to", "label").alias("label")), name, nodes)
        moved = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        rest = stored(moved.where("a <> b").distinct(), name, size)
        discard(edges, labels, first)
        edges, labels, turn, size = rest, named, turn + 1, rest.count()
    discard(edges)
    return labels
