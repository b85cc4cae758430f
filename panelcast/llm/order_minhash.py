"""Order MinHash fingerprints, whose likeness follows the edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelcast.llm.encode import portions
from panelcast.llm.hashing import mixed
from panelcast.llm.shared import stored, tidy

K, TUPLES, PICKS = 6, 64, 2
_SPREAD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """Hashes of the text's runs of ``k`` code points, each with its occurrence number; a shorter text is one run."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return points
    h, width = mixed(points + np.uint64(1)), 1
    k = min(k, len(points))
    while width < k:  # runs of twice the width, or overlapping ones for the last step
        step = min(width, k - width)
        h = mixed(h[: len(h) - step] * _SPREAD[0] + h[step:] * _SPREAD[1] + np.uint64(step))
        width += step
    ordered = np.sort(h)
    repeats = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(repeats):
        at = np.flatnonzero(np.isin(h, repeats))
        by_value = at[np.argsort(h[at], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], h[by_value][1:] != h[by_value][:-1]]))
        runs = np.diff(np.append(first, len(by_value)))
        number = np.arange(len(by_value)) - np.repeat(first, runs)
        h[by_value] += number.astype(np.uint64) * _SPREAD[2]
    return mixed(h)


def fingerprint(text: str, k: int = K, tuples: int = TUPLES, picks: int = PICKS) -> np.ndarray:
    """One 16-bit number for each of ``tuples`` parts of the hash range, 0 where a part has no k-mer.

    The ``picks`` least numbered k-mers of a part, put in the order in which
    they stand in the text, are hashed together.
    """
    h = numbered_kmers(text, k)
    n = len(h)
    if not n:
        return np.zeros(tuples, np.uint16)
    order = np.argsort(h)
    edges = np.arange(tuples, dtype=np.uint64) * np.uint64((1 << 64) // tuples)
    starts = np.searchsorted(h[order], edges)
    ends = np.append(starts[1:], n)
    picked = starts[:, None] + np.arange(picks)
    places = np.where(picked < ends[:, None], order[np.minimum(picked, n - 1)], n)
    places.sort(axis=1)
    values = np.append(h, np.uint64(0))[places]
    joined = values[:, 0].copy()
    for j in range(1, picks):
        joined = mixed(joined * _SPREAD[3] + values[:, j])
    return np.where(starts < ends, (joined >> np.uint64(48)) | np.uint64(1), np.uint64(0)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal tuples among those that either text has; 1 for two empty texts."""
    either = (a != 0) | (b != 0)
    return float(((a == b) & either).sum() / either.sum()) if either.any() else 1.0


def _bytes(numbers: np.ndarray) -> bytes:
    return numbers.astype(">u2").tobytes()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Digests are written as bytes and come out in hex.
FINGERPRINT_SCHEMA = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _row(text: str, own: np.ndarray, following: str, following_print: np.ndarray) -> tuple:
    changed = edited(text, following)
    changed_print = fingerprint(changed)
    return len(text), hashlib.sha256(changed.encode()).digest(), _bytes(own), _bytes(changed_print), likeness(own, changed_print), likeness(own, following_print)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each text, and how near it is to those of its edited text and of the next text.

    The next text is that of the next doc_id (nulls first; rows of one doc_id
    in the order of their text's hash), after the last the first; a single row
    is next to itself. A null text is empty. Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next;
    others are not read. The texts are shuffled once, by ranges of doc_id;
    only the first and last text of each range go through a second step.
    """
    doc_type = docs.schema["doc_id"].dataType
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    names = ["part", "doc_id", "first_text", "text", *(f.split()[0] for f in FINGERPRINT_SCHEMA.split(", "))]
    schema = f"part int, doc_id {doc_type.simpleString()}, first_text string, text string, {FINGERPRINT_SCHEMA}"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, kinds = None, None, None  # held: the row whose next is not known yet
        for batch in portions(batches):
            out = []
            kinds = [pa.int32(), batch.schema.field("doc_id").type, pa.string(), pa.string(), pa.int64(), *[pa.binary()] * 3, pa.float64(), pa.float64()]
            part = batch["part"][0].as_py() if batch.num_rows else None
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = fingerprint(text)
                if held:
                    out.append((part, held[0], None, None, *_row(held[1], held[2], text, own)))
                else:
                    first = text
                held = (doc, text, own, part)
            yield _table(out, kinds, names)
        if held:
            doc, text, _, part = held
            yield _table([(part, doc, first, text, *[None] * 6)], kinds, names)

    done = stored(ranges.mapInArrow(tidy(stream), schema), "fingerprints")
    lasts = done.where("text IS NOT NULL")
    # one row a range: which range's first text follows its last
    order = lasts.select("part").withColumn("then", F.lead("part").over(Window.orderBy("part")))
    order = order.withColumn("then", F.coalesce("then", F.min("part").over(Window.partitionBy())))
    following = lasts.select(F.col("part").alias("then"), F.col("first_text").alias("following"))
    border = lasts.select("part", "doc_id", "text").join(order, "part").join(following, "then").select("doc_id", "text", "following")
    result = ["doc_id", *(f.split()[0] for f in FINGERPRINT_SCHEMA.split(", "))]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(doc, *_row(t, fingerprint(t), n, fingerprint(n))) for doc, t, n in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "following")), strict=True)]
            yield _table(out, [batch.schema.field("doc_id").type, pa.int64(), *[pa.binary()] * 3, pa.float64(), pa.float64()], result)

    ends = border.mapInArrow(tidy(finish), f"doc_id {doc_type.simpleString()}, {FINGERPRINT_SCHEMA}")
    whole = done.where("text IS NULL").select(*result).unionByName(ends)
    return whole.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def _table(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
