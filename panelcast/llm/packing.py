"""Best-fit packing of token pieces into sequences of a fixed length."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from panelcast.llm.encode import encoder, portions, slices
from panelcast.llm.shared import released, stored, tidy

PIECE_FIELDS = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document.

    A document's ids are those of its text (null: empty) and ``end_id``. Only
    longer ones are cut, into pieces of ``capacity``; what remains is the first
    piece. Columns: doc_id, piece, start, length, ids_crc32 and, if
    ``keep_ids``, ids (little-endian unsigned 32-bit). Repeated rows and null
    doc_ids are documents like others; other columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *PIECE_FIELDS, *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])
    end = array("I", [end_id]).tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, arrow = encoder(tokenizer).encode, None
        for batch in portions(batches):
            rows = list(zip(batch["doc_id"].to_pylist(), (t or "" for t in batch["text"].to_pylist()), strict=True))
            for run in slices(rows, lambda r: len(r[1])):
                out = []
                for (doc, _), ids in zip(run, encode([t for _, t in run]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    for k, start in enumerate([0, *range(first, n, capacity)]):
                        length = min(n, first + k * capacity) - start
                        part = ids[4 * start : 4 * (start + length)]
                        out.append((doc, k, start, length, zlib.crc32(part), *([part] if keep_ids else [])))
                arrow = arrow or pa.schema([pa.field("doc_id", batch.schema.field("doc_id").type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if keep_ids else [])])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(tidy(pieces), schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin, and the space that each bin has left."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, left = 0, []  # bit s of spaces: some bin has s tokens left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = spaces >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            k = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, k = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i], left[k] = k, capacity - space, space - size
        by_space[space - size].append(k)
        spaces |= 1 << (space - size)
    return bins, offsets, np.array(left, np.int64)


def bin_bound(lengths: np.ndarray, capacity: int, parts: int = 40) -> int:
    """Least number of bins, by dual feasible functions, in whole numbers.

    First family: for each e, sizes over capacity - e count as whole bins and
    those under e as nothing (e = 0: the sum). Second: for each k, the size s
    counts as floor((k + 1) s / capacity) k-ths, and as itself where (k + 1) s
    is a multiple of the capacity.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(object if len(lengths) > 1 << 40 else np.int64)
    size = np.arange(capacity + 1)
    total, number = np.cumsum(count * size), np.cumsum(count)
    best = 0
    for e in range(capacity // 2 + 1):
        low = total[e - 1] if e else 0
        worth = (number[-1] - number[capacity - e]) * capacity + total[capacity - e] - low
        best = max(best, -(-int(worth) // capacity))
    for k in range(1, parts + 1):
        worth = np.where((k + 1) * size % capacity == 0, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((worth * count).sum()) // (k * capacity)))
    return best


def pack(pieces: DataFrame, capacity: int = 2048, group_pieces: int = 1 << 16, rounds: int = 4) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` from 1 to ``capacity``.

    Full pieces are sequences of their own. The others are dealt by hash into
    groups of about ``group_pieces``; each is packed by best-fit decreasing and
    certified if its bins equal the bound of the dual feasible functions.
    Groups with a gap exchange their pieces: these, and the emptiest bin of
    each certified group, are dealt anew and packed again, up to ``rounds``
    times; a round that does not save a sequence is not taken. Every row comes
    back once, repeated rows too; an empty input gives an empty result.
    """
    if {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("pieces already have sequence_id or offset")
    own = pieces.columns
    work = stored(pieces.select(F.struct(*own).alias("row"), F.col("length").cast("long").alias("size"), F.monotonically_increasing_id().alias("uid")), "pieces")
    schema = T.StructType([*work.schema.fields, *(T.StructField(c, T.LongType()) for c in ("grp", "bin", "offset", "bins", "bound")), T.StructField("emptiest", T.BooleanType())])

    def one_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        lengths = rows["size"].to_numpy()
        bins, offsets, left = best_fit_decreasing(lengths, capacity)
        made = rows.assign(bin=bins, offset=offsets, bins=len(left), bound=bin_bound(lengths, capacity), emptiest=bins == int(left.argmax()))
        released()
        return made

    done = [work.where(F.col("size") >= capacity).select("row", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    pool, before, previous = work.where(F.col("size") < capacity), None, None
    for turn in range(rounds):
        groups = max(1, -(-pool.count() // group_pieces))
        dealt = pool.select(*work.columns, F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)).alias("grp"))
        packed = stored(dealt.groupBy("grp").applyInPandas(one_group, schema), f"packed-{turn}").withColumn("turn", F.lit(turn))
        found = packed.groupBy("grp").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"))
        open_group = F.col("bins") > F.col("bound")
        bins, exchanged = found.agg(F.sum("bins"), F.sum(F.when(open_group, F.col("bins")).otherwise(1))).first()
        if before is not None and (bins or 0) >= before:
            done.append(_placed(previous))
            break
        if groups == 1 or turn == rounds - 1:
            done.append(_placed(packed))
            break
        to_exchange = open_group | F.col("emptiest")
        done.append(_placed(packed.where(~to_exchange)))
        previous = pool = packed.where(to_exchange)
        before = exchanged
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("row.*", "sequence_id", "offset")


def _placed(packed: DataFrame) -> DataFrame:
    """Sequence numbers that no other round or group gives."""
    number = F.col("turn").cast("long") * F.lit(1 << 58) + F.col("grp") * F.lit(1 << 24) + F.col("bin")
    return packed.select("row", number.alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences of pieces with ids: sequence_id, ids, doc_ids, lengths."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.length").alias("lengths"),
    )
