"""Removal of lines that spread over many sites, in DataFrame operations only."""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import DataFrame, functions as F

from panelcast.llm.shared import stored

#: Shares of each spread line's occurrences in the join that marks them.
SALTS = 16


def line_table(docs: DataFrame, site: str = "source") -> DataFrame:
    """The non-blank lines: doc_id, copy (hash of the text), doc (hash of both), size (characters of all lines), n (distinct lines), pos, line (hash of the trimmed line), chars, site."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(x))
    held = docs.select("doc_id", F.xxhash64("text").alias("copy"), F.col(site).alias("site"), F.transform(trimmed, lambda x: F.struct(F.when(x != "", F.xxhash64(x)).alias("line"), F.length(x).alias("chars"))).alias("held"))
    size = F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + x["chars"])
    n = F.size(F.array_distinct(F.array_compact(F.transform("held", lambda x: x["line"]))))
    own = held.select("doc_id", "copy", F.xxhash64("doc_id", "copy").alias("doc"), size.alias("size"), n.alias("n"), "site", F.posexplode("held").alias("pos", "held"))
    return own.where("held.line IS NOT NULL").select("doc_id", "copy", "doc", "size", "n", "pos", "held.line", "held.chars", "site")


def shared_lines(lines: DataFrame) -> DataFrame:
    """The rows of lines that occur more than once, with ``first``: the least (doc_id, copy, pos), its doc, size and n."""
    place = F.struct("doc_id", "copy", "pos", "doc", "size", "n")
    often = lines.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("line", "first")
    salted = stored(often, "often").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("doc", "pos"), F.lit(SALTS)).cast("int"))
    return stored(dealt.join(salted, ["line", "salt"]).select(*lines.columns, "first"), "shared")


def copies(shared: DataFrame) -> DataFrame:
    """doc, origin: documents that are copies of an earlier one.

    A copy has lines from one document, where these occur first, that are more
    than half of the distinct lines of both, or two lines or more that are
    more than half of the characters of both. A line counts once. Lines that
    make up little of a document make it no copy, however many documents have
    them, and neither does one long line beside others. Of two such documents
    the one with more characters in common counts, then the later one.
    """
    place = F.struct("first.doc_id", "first.copy", "first.doc", "first.size", "first.n")
    own = shared.select("doc", "size", "n", "line", "chars", place.alias("origin")).where("doc <> origin.doc").distinct()
    pairs = own.groupBy("doc", "size", "n", "origin").agg(F.count(F.lit(1)).alias("lines"), F.sum("chars").alias("common"))
    like = "2 * lines > n AND 2 * lines > origin.n OR lines > 1 AND 2 * common > size AND 2 * common > origin.size"
    return pairs.where(like).groupBy("doc").agg(F.max(F.struct("common", "origin"))["origin"]["doc"].alias("origin"))


def spread_lines(lines: DataFrame, min_sites: int, lg_k: int = 12) -> tuple[DataFrame, DataFrame]:
    """Lines on at least ``min_sites`` distinct sites (line), and ``shared_lines``.

    A document and its copies give one site together, the least, so a line
    that only copies spread is not spread. Each line's sites are sketched by
    HyperLogLog, merged by aggregation. A line whose estimate is further from
    the threshold than three standard errors (and one) is decided by it; the
    others get an exact distinct count. A null site is no site.
    """
    shared = shared_lines(lines)
    found = stored(copies(shared), "copies")
    origins = shared.select("line", "doc", "site").join(found, "doc", "left").groupBy("line", F.coalesce("origin", "doc").alias("body")).agg(F.min("site").alias("site"))
    origins = stored(origins.where("site IS NOT NULL").select("line", "site").distinct(), "line-sites")  # a hot line is one row a site from here
    sketched = origins.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    estimated = sketched.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - _band(min_sites, lg_k))
    estimated = stored(estimated, "sketched")
    near = F.abs(F.col("sites") - min_sites) <= _band(min_sites, lg_k)
    own = origins.join(estimated.where(near).select("line"), "line", "left_semi")
    exact = own.groupBy("line").agg(F.count(F.lit(1)).alias("exact")).where(F.col("exact") >= min_sites)
    return exact.select("line").unionByName(estimated.where(~near).select("line")), shared


def _band(min_sites: int, lg_k: int) -> int:
    return max(1, ceil(3 * 1.04 / sqrt(1 << lg_k) * min_sites))


def remove_spread_lines(docs: DataFrame, min_sites: int = 3, site: str = "source", lg_k: int = 12) -> DataFrame:
    """``docs`` without lines found on ``min_sites`` distinct sites, plus n_lines and n_removed.

    A spread line stays where it occurs first (least doc_id, then position),
    so its content is not lost; everywhere else it goes, and a document of
    nothing else is left empty. A document and its ``copies`` count as one
    site, so copies keep their lines for document-level deduplication. Lines
    are compared without outer spaces; blank lines are never removed. A null
    text stays null with no lines; rows with equal doc_id and text get equal
    results; all columns stay, and names taken by n_lines or n_removed raise.
    """
    if {"n_lines", "n_removed"} & set(docs.columns):
        raise ValueError("the documents already have n_lines or n_removed")
    lines = stored(line_table(docs, site), "lines")
    spread, shared = spread_lines(lines, min_sites, lg_k)
    salted = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    again = shared.where(~F.struct("doc_id", "copy", "pos").eqNullSafe(F.struct("first.doc_id", "first.copy", "first.pos")))
    again = again.withColumn("salt", F.pmod(F.xxhash64("doc", "pos"), F.lit(SALTS)).cast("int")).join(salted, ["line", "salt"])
    marks = again.groupBy(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")).agg(F.sort_array(F.collect_set("pos")).alias("_drop"))
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"))
    joined = own.join(marks, own["_id"].eqNullSafe(marks["_doc"]) & (F.col("_key") == F.col("_copy")), "left")
    # a column of its own, so that nothing is split again for each line
    marked = joined.withColumn("_parts", F.split("_row.text", "\n")).withColumn("_drop", F.coalesce("_drop", F.array().cast("array<int>")))
    # the parts between the removed positions, so the work grows with the lines only
    kept = F.expr(
        "array_join(flatten(transform(sequence(1, size(_drop) + 1), j -> slice(_parts,"
        " if(j = 1, 1, try_element_at(_drop, j - 1) + 2),"
        " coalesce(try_element_at(_drop, j), size(_parts)) - if(j = 1, 0, try_element_at(_drop, j - 1) + 1)))), '\n')"
    )
    text = F.when(F.size("_drop") == 0, F.col("_row.text")).otherwise(kept)
    n_lines = F.size(F.filter("_parts", lambda x: F.trim(x) != "")).cast("long")
    columns = [text.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return marked.select(*columns, F.when(F.col("_row.text").isNull(), F.lit(0)).otherwise(n_lines).cast("long").alias("n_lines"), F.size("_drop").cast("long").alias("n_removed"))


def oracle(min_sites: int = 3) -> str:
    """The same result in SQL, with exact counts, where doc_id is unique."""
    return f"""
    WITH parts AS (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM documents WHERE text IS NOT NULL),
    lines AS (SELECT doc_id, source, pos, trim(content, ' ') AS line, content FROM parts),
    own AS (SELECT doc_id, line, min(source) AS source, min(pos) AS pos FROM lines WHERE line <> '' GROUP BY doc_id, line),
    sizes AS (SELECT doc_id, sum(length(line)) AS size, count(DISTINCT line) AS n FROM lines WHERE line <> '' GROUP BY doc_id),
    firsts AS (SELECT line, min(doc_id) AS doc_id, arg_min(pos, (doc_id, pos)) AS pos FROM own GROUP BY line),
    copies AS (
        SELECT c.doc_id, arg_max(c.origin, (common, c.origin)) AS origin
        FROM (SELECT o.doc_id, f.doc_id AS origin, count(*) AS n, sum(length(line)) AS common FROM own o JOIN firsts f USING (line) WHERE o.doc_id <> f.doc_id GROUP BY ALL) c
        JOIN sizes a ON a.doc_id = c.doc_id JOIN sizes b ON b.doc_id = c.origin
        WHERE (2 * c.n > a.n AND 2 * c.n > b.n) OR (c.n > 1 AND 2 * common > a.size AND 2 * common > b.size) GROUP BY c.doc_id),
    bodies AS (SELECT line, coalesce(origin, o.doc_id) AS body, min(source) AS source FROM own o LEFT JOIN copies c USING (doc_id) GROUP BY ALL),
    spread AS (SELECT f.* FROM firsts f JOIN (SELECT line FROM bodies GROUP BY line HAVING count(DISTINCT source) >= {min_sites}) USING (line)),
    marked AS (
        SELECT l.*, s.line IS NOT NULL AND (s.doc_id, s.pos) <> (l.doc_id, l.pos) AS removable
        FROM lines l LEFT JOIN spread s USING (line)),
    kept AS (
        SELECT doc_id, string_agg(CASE WHEN removable THEN NULL ELSE content END, chr(10) ORDER BY pos) AS text,
               count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (removable) AS n_removed
        FROM marked GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
           CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
    FROM documents d LEFT JOIN kept k USING (doc_id)
    """
