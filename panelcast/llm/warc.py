"""WARC archives: writing with revisits, and reading by verified record boundaries.

Reading splits the files at every occurrence of the version line, also those
inside payloads. Each candidate names the place of its successor; only those
that the chain from the file's start reaches are records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelcast.llm.encode import portions
from panelcast.llm.shared import stored, tidy

VERSION = "WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SALTS = 16


def base32(hex_digest):
    """Upper-case base32 of a hex SHA-1: five hex digits are four of base32."""
    part = lambda i: F.lpad(F.upper(F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32)), 4, "0")
    return F.translate(F.concat(*(part(i) for i in range(8))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, sha) whose payload of at least ``min_bytes`` a page with a larger page_id has too, with that page's id as ``keeper``.

    The largest ids come from a partial aggregation; the join back has the hot
    payloads' pages spread over salts.
    """
    digests = pages.where(F.octet_length("html") >= min_bytes).select("page_id", F.sha1("html").alias("sha"))
    kept = digests.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1 AND keeper IS NOT NULL")
    salted = kept.select("sha", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = digests.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["sha", "salt"])
    return found.where(~F.col("page_id").eqNullSafe(F.col("keeper"))).select("page_id", "sha", "keeper").distinct()


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Writes one record per row of ``pages`` (page_id, url, html), uncompressed.

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads
    of at least ``min_revisit_bytes`` those with the largest page_id are
    responses, the others revisit it; a null page_id counts as the least. A
    null url leaves the target out; line breaks in it are escaped. Other
    columns are not read. The pages are not shuffled unless the revisits are
    too many for Spark to broadcast.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    back = stored(revisits(rows, min_revisit_bytes), "revisits")  # its size is known before the join
    back = back.select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "keeper")
    rows = rows.withColumn("sha", F.sha1("html"))
    rows = rows.join(back, rows["page_id"].eqNullSafe(back["_page"]) & (rows["sha"] == back["_sha"]), "left")
    again, size = F.col("keeper").isNotNull(), F.octet_length("html").cast("string")
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(VERSION + "WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32(F.col("sha")),
        F.lit("\r\nWARC-Payload-Length: "), size,
        F.when(again, F.concat(F.lit("\r\nWARC-Refers-To: "), record_id(F.col("keeper")), F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    # the line end that the text writer adds is the record's last byte
    rows.select(F.concat(head, block, F.lit("\r\n\r")).alias("value")).write.option("lineSep", "\n").text(path)


def parse_record(segment: bytes) -> tuple[dict[str, str], int, int] | None:
    """Headers, where the block starts, and its length, of what follows a version line; None if it is no record."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    headers = {}
    for line in segment[:end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            return None
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    return (headers, end + 4, int(length)) if length.isascii() and length.isdigit() else None


def _page(record_id: str | None) -> int | None:
    value = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value.removeprefix("-").isdigit() else None


RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"
#: ``problem`` says why a record can't be right; it counts only if the chain reaches the record.
FOUND_SCHEMA = f"{RECORD_SCHEMA}, problem string"
CANDIDATE_SCHEMA = f"file string, block long, at long, length long, next long, exit long, {FOUND_SCHEMA}"
FOUND_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]


def record_row(segment: bytes) -> tuple:
    """The row of a whole record (FOUND_SCHEMA).

    A response's payload follows its HTTP head; its length and digest are
    taken from it, and checked against those that the headers state, if they
    do. A revisit has the stated ones. Of any other type (warcinfo, request,
    metadata, ...) the payload is the whole block.
    """
    headers, start, length = parse_record(segment)
    block, kind = segment[start : start + length], headers.get("warc-type", "unknown")
    stated_size, stated_digest = headers.get("warc-payload-length"), headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    stated_size = int(stated_size) if stated_size and stated_size.isascii() and stated_size.isdigit() else None
    problem = None
    if kind == "revisit":
        size, digest = stated_size, stated_digest
    else:
        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" and block.startswith(b"HTTP/") else block
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        by_sha1 = headers.get("warc-payload-digest", "").startswith("sha1:")
        if kind == "response" and (size != (size if stated_size is None else stated_size) or by_sha1 and digest != stated_digest):
            problem = f"record {headers.get('warc-record-id')}: payload differs from its digest or length"
    return _page(headers.get("warc-record-id")), size, digest, kind, _page(headers.get("warc-refers-to")), headers.get("warc-target-uri"), problem


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Bytes between version lines, in file order inside each block that one task reads."""
    text = spark.read.option("lineSep", VERSION).option("recursiveFileLookup", True).text(path)
    return text.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """Each segment's block, its place after the block's first byte, and its bytes."""
    key, at = None, 0
    for batch in batches:
        for file, block, value in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["value"], strict=True):
            if (file, block) != key:
                key, at = (file, block), 0
            data = value.as_py()
            yield key, at, data
            at += len(data) + len(VERSION)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per segment: its place in the block, its successor's, and where the chain from it leaves the block.

    The record's own columns are there if the segment holds it whole.
    """

    def emit(key: tuple, rows: list[tuple], end: int) -> pa.RecordBatch:
        leave: dict[int, int] = {}
        for at, _, after, _ in reversed(rows):
            if after is not None:
                leave[at] = leave.get(after, after) if after < end else after
        whole = [(*key, at, length, after, leave.get(at), *(found or [None] * 7)) for at, length, after, found in rows]
        kinds = [pa.string(), *[pa.int64()] * 5, *FOUND_KINDS]
        names = [f.split()[0] for f in CANDIDATE_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*whole, strict=True), kinds, strict=True)], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, end = None, [], 0
        for key, at, data in _located(batches):
            if key != held and rows:
                yield emit(held, rows, end)
                rows = []
            held, end = key, at + len(data) + len(VERSION)
            parsed, after, found = parse_record(data), None, None
            if parsed:
                size = parsed[1] + parsed[2] + 4
                after = at + size + len(VERSION)  # the segment starts after its version line
                if size == len(data):
                    found = record_row(data)
            rows.append((at, len(data), after, found))
        if rows:
            yield emit(held, rows, end)

    return segments(spark, path).mapInArrow(tidy(scan), CANDIDATE_SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: RECORD_SCHEMA, and file and offset of each.

    A revisit has the length and digest that its header states, those of other
    records are taken from them (``record_row``); records that are not of
    pages written here have a null page_id. A response that differs from its
    digest or length raises, and so does a file in which the chain does not
    end at the file's end.
    """
    seen = stored(candidates(spark, path), "candidates")
    sizes = seen.groupBy("file", "block").agg(F.max(F.col("at") + F.col("length")).alias("size"))
    # all but a file's last segment are followed by a version line
    before = Window.partitionBy("file").orderBy("block")
    version = F.lit(len(VERSION))
    sizes = sizes.select("file", "block", F.coalesce(F.sum(F.col("size") + version).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), "size")
    sizes = stored(sizes, "blocks")
    placed = seen.join(sizes, ["file", "block"]).withColumns({c: F.col("base") + F.col(c) for c in ("at", "next", "exit")})
    ends = sizes.groupBy("file").agg(F.max(F.col("base") + F.col("size") + version).alias("file_end"))
    entries = stored(_entries(placed.where("exit IS NOT NULL").select("file", "block", "at", "exit"), ends), "entries")
    marks = _walk(placed.select("file", "block", "at", "next"), entries)
    whole = placed.drop("base", "size", "block", "length", "exit").join(marks, ["file", "at"])
    simple, split = whole.where("record_type IS NOT NULL"), stored(whole.where("record_type IS NULL").select("file", "at", "next"), "split")

    def rows(found: DataFrame) -> DataFrame:
        sound = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("problem")).cast("boolean"))
        return found.where(sound).select(*(f.split()[0] for f in RECORD_SCHEMA.split(", ")), "file", (F.col("at") - version).alias("offset"))

    return rows(simple) if split.isEmpty() else rows(simple).unionByName(rows(_stitched(spark, path, placed, split)))


def _entries(jumps: DataFrame, ends: DataFrame) -> DataFrame:
    """Candidates at which the chain from each file's start enters a block, by pointer jumping.

    Only candidates that another block's chain leads to, and those at file
    starts, can be entries; each round doubles the blocks that a jump passes.
    """
    start = F.lit(len(VERSION))
    targets = jumps.select("file", F.col("exit").alias("at")).unionByName(jumps.select("file", start.cast("long").alias("at"))).distinct()
    hop = stored(jumps.join(targets, ["file", "at"]).select("file", "at", "exit"), "hops")
    reached, count = hop.where(F.col("at") == start).select("file", "at"), -1
    while True:
        reached = stored(reached.unionByName(reached.join(hop, ["file", "at"]).select("file", F.col("exit").alias("at"))).distinct(), "reached")
        grown = reached.count()
        if grown == count:
            break
        count = grown
        further = hop.select("file", F.col("at").alias("exit"), F.col("exit").alias("then"))
        hop = stored(hop.join(further, ["file", "exit"], "left").select("file", "at", F.coalesce("then", "exit").alias("exit")), "hops")
    broken = ends.where("file_end > %d" % len(VERSION)).join(reached.select("file", F.col("at").alias("file_end")), ["file", "file_end"], "left_anti").limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0]['file']}: the chain of records does not end at the file's end")
    return reached


def _walk(placed: DataFrame, entries: DataFrame) -> DataFrame:
    """The candidates of each block that its entry's chain passes: the records."""
    marked = placed.join(entries.withColumn("entry", F.lit(True)), ["file", "at"], "left")

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        after = dict(zip(rows["at"].tolist(), rows["next"].tolist(), strict=True))
        on: set[int] = set()
        for at in rows.loc[rows["entry"].notna(), "at"].tolist():
            while at in after and at not in on:
                on.add(at)
                at = after[at]
        return pd.DataFrame({"file": key[0], "at": sorted(int(a) for a in on)})

    return marked.select("file", "block", "at", "next", "entry").groupBy("file", "block").applyInPandas(walk, "file string, at long")


def _stitched(spark: SparkSession, path: str, placed: DataFrame, split: DataFrame) -> DataFrame:
    """Records whose payload holds the version line, put together from their segments."""
    owners = split.select("file", "at", F.col("at").alias("owner"))
    so_far = Window.partitionBy("file").orderBy("at")
    records = placed.join(split.select("file").distinct(), "file", "left_semi").join(owners, ["file", "at"], "left")
    # a segment belongs to the last record that starts at or before it
    starts = F.last("owner", ignorenulls=True).over(so_far)
    needed = records.withColumn("owner", starts).select("file", "owner", "block", F.col("at").alias("place"), (F.col("at") - F.col("base")).alias("at"))
    needed = needed.join(split.select("file", F.col("at").alias("owner"), "next"), ["file", "owner"]).where("place < next").drop("next")

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, at, data in _located(batches):
            yield pa.RecordBatch.from_pydict({"file": pa.array([key[0]]), "block": pa.array([key[1]], pa.int64()), "at": pa.array([at], pa.int64()), "value": pa.array([data], pa.binary())})

    parts = segments(spark, path).mapInArrow(tidy(raw), "file string, block long, at long, value binary").join(needed, ["file", "block", "at"])

    def join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for file, owner, held in zip(batch["file"].to_pylist(), batch["owner"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                rows.append((*record_row(VERSION.encode().join(p["value"] for p in held)), file, owner))
            kinds = [*FOUND_KINDS, pa.string(), pa.int64()]
            names = [*(f.split()[0] for f in FOUND_SCHEMA.split(", ")), "file", "at"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    whole = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"))
    return whole.mapInArrow(tidy(join_parts), f"{FOUND_SCHEMA}, file string, at long")


def oracle() -> str:
    """page_id, payload_bytes, payload_digest, record_type and refers_to in SQL."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    part = f"list_aggregate(list_transform([15, 10, 5, 0], lambda s: substr({letters}, ((CAST('0x' || substr(sha, 5 * i + 1, 5) AS BIGINT) >> s) & 31) + 1, 1)), 'string_agg', '')"
    return f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
    kept AS (SELECT html, max(page_id) AS keeper FROM payloads GROUP BY html)
    SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
           list_aggregate(list_transform(range(8), lambda i: {part}), 'string_agg', '') AS payload_digest,
           CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
    FROM payloads JOIN kept USING (html)
    """
