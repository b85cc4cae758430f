"""Length-delimited binary records of token ids with an offset index.

A record, integers little-endian:

    length    8 bytes  of the payload
    check     4 bytes  masked CRC-32 of the length's bytes
    payload            the serialised sequence
    check     4 bytes  masked CRC-32 of the payload
    end       1 byte   0x0A

A payload is one byte of flags (1: no doc_id; 2: ids of four bytes, else two),
the doc_id (8 bytes) and the ids. The mask turns a CRC right by 15 bits and
adds a constant, so that data which themselves hold CRCs are checked well.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelcast.llm.encode import encoder, portions, slices
from panelcast.llm.shared import tidy

MASK_DELTA = 0xA282EAD8
HEAD, PAYLOAD_HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<Bq"), struct.Struct("<IB")
END = 0x0A


def masked_crc(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """The record of 32-bit ids; 16 bits are kept where all ids fit."""
    wide = np.frombuffer(ids, "<u4")
    narrow = not len(wide) or int(wide.max()) < 1 << 16
    payload = PAYLOAD_HEAD.pack((doc_id is None) + 2 * (not narrow), doc_id or 0) + (wide.astype("<u2").tobytes() if narrow else ids)
    length = struct.pack("<Q", len(payload))
    return HEAD.pack(len(payload), masked_crc(length)) + payload + TAIL.pack(masked_crc(payload), END)


def frame_at(data: bytes | memoryview | pa.Buffer, at: int) -> tuple[memoryview, int]:
    """The payload of the record at a place, checked, and the next record's place."""
    data = memoryview(data)
    length, check = HEAD.unpack_from(data, at)
    if masked_crc(data[at : at + 8]) != check:
        raise ValueError(f"damaged length at byte {at}")
    start = at + HEAD.size
    payload = data[start : start + length]
    check, end = TAIL.unpack_from(data, start + length)
    if masked_crc(payload) != check or end != END:
        raise ValueError(f"damaged payload at byte {at}")
    return payload, start + length + TAIL.size


def ids_of(payload: bytes | memoryview) -> tuple[int | None, np.ndarray]:
    flags, doc_id = PAYLOAD_HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=PAYLOAD_HEAD.size)
    return (None if flags & 1 else doc_id), ids.astype("<u4")


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_bytes: int = 32 << 20) -> None:
    """Writes the ids of every whole text and ``end_id``, in ascending doc_id order over the files.

    ``doc_id`` is an integer; null ids come first, rows of one id in the order
    of their text's hash. A null text is empty. Texts of about ``shard_bytes``
    go to one file, so files stay bounded at any input size; long runs of one
    id are split too. An empty table writes no record. Other columns are not
    read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(max(1, -(-total // shard_bytes)), *keys).sortWithinPartitions(*keys)
    end = array("I", [end_id]).tobytes()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in portions(batches):
            rows = list(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True))
            for run in slices(rows, lambda r: len(r[1])):
                done = [frame(doc, ids + end) for (doc, _), ids in zip(run, encode([t for _, t in run]), strict=True)]
                yield pa.RecordBatch.from_pydict({"frame": pa.array(done, pa.binary())})

    # the line end that the text writer adds is the record's last byte
    framed = ordered.mapInArrow(tidy(frames), "frame binary").select(F.expr("substr(frame, 1, length(frame) - 1)").cast("string").alias("value"))
    framed.write.option("lineSep", chr(END)).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


INDEX_SCHEMA = "file string, ordinal long, byte_offset long, byte_length long, doc_id long, n_tokens long, ids_crc32 long"


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Reads all files, verifies every record, and writes the offset index.

    A row per record: file, ordinal in it, byte_offset, byte_length, doc_id,
    n_tokens and ids_crc32 (of the ids as 32-bit integers). A damaged record
    raises.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["file"].to_pylist(), batch["content"], strict=True):
                data, at, found = content.as_buffer(), 0, []
                while at < len(data):
                    payload, after = frame_at(data, at)
                    doc_id, ids = ids_of(payload)
                    found.append((file, len(found), at, after - at, doc_id, len(ids), zlib.crc32(ids)))
                    at = after
                yield _batch(found, [pa.string(), *[pa.int64()] * 6], INDEX_SCHEMA)

    _files(spark, path).mapInArrow(tidy(scan), INDEX_SCHEMA).write.parquet(index_path)
    return spark.read.schema(INDEX_SCHEMA).parquet(index_path)


def _batch(rows: list[tuple], kinds: list, schema: str) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_records(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """The records that an index names, for shuffled reads: file, ordinal, doc_id, ids.

    ``index`` may be any part of the written index, as a sampler draws it; only
    its files are read. ids are little-endian unsigned 32-bit integers.
    """
    schema = "file string, ordinal long, doc_id long, ids binary"
    wanted = index.groupBy("file").agg(F.collect_list(F.struct("ordinal", "byte_offset")).alias("places"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content, places in zip(batch["file"].to_pylist(), batch["content"], batch["places"].to_pylist(), strict=True):
                data = content.as_buffer()
                for run in slices(places, lambda p: 1, 2_000):
                    out = []
                    for place in run:
                        doc_id, ids = ids_of(frame_at(data, place["byte_offset"])[0])
                        out.append((file, place["ordinal"], doc_id, ids.tobytes()))
                    yield _batch(out, [pa.string(), pa.int64(), pa.int64(), pa.binary()], schema)

    return _files(spark, path).join(wanted, "file").mapInArrow(tidy(read), schema)


def token_starts(records: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all records before, files in name order.

    A running sum inside each file and one over the files' totals; only the
    totals, one row a file, meet in one task.
    """
    before = Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = records.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    local = records.withColumn("local", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return local.join(bases, "file").withColumn("start", F.col("base") + F.col("local")).drop("base", "local")
