"""CSV folders of any layouts, and table sinks that can be run again."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F, types as T

from panelcast.functions.dates import lenient_timestamp
from panelcast.schema import BARS_CSV, require_columns
from panelcast.session import exists, move, remove, stored

_BAD = "rejected_cells"
_LINE = "_line"
#: Files are read one scan per header; a folder with more headers than this holds something else.
MAX_LAYOUTS = 200
#: Commas outside of quotes.
_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _header_name(column: str) -> str:
    """``Adj Close`` -> adj_close."""
    return column.strip().lower().replace(" ", "_")


def file_manifest(spark: SparkSession, path: str, date: str = "date", required: tuple[str, ...] = ("close",)) -> DataFrame:
    """What is in a folder of CSV files, a row per file: ``file, path, bytes, header, n_lines, n_wrong, status``.

    One pass over the text gives every file's first line (``header``, its
    names as written), its further lines that are not blank, and those among
    them with another number of cells (``n_wrong``). The status is
    ``unreadable`` (no text in it: a broken archive, or blank lines only),
    ``no_date`` or ``no_<name>`` (a ``required`` column is missing), ``no_rows``,
    ``wrong_cells`` (some lines), or ``ok``. A bad file costs only itself.
    Quoted cells may hold commas but not line breaks. Files without a byte are
    not listed; a path without files gives no rows.
    """
    schema = "file string, path string, bytes long, header array<string>, n_lines long, n_wrong long, status string"
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        lines = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
    listed = listed.select(F.col("_metadata.file_path").alias("key"), F.element_at(F.split("path", "/"), -1).alias("file"), "path", F.col("length").alias("bytes"))
    value = F.regexp_replace("value", "\\r$", "")
    lines = lines.select(F.col("_metadata.file_path").alias("key"), F.col("_metadata.file_block_start").alias("block"), value.alias("value"), F.monotonically_increasing_id().alias("at"))
    lines = lines.where(F.trim("value") != "").withColumn("cells", F.size(F.split("value", _COMMA)))
    at_start = F.when(F.col("block") == 0, F.struct("at", "value"))
    # a row for each file and number of cells, so a long file is added up where it is read
    counted = lines.groupBy("key", "cells").agg(F.count(F.lit(1)).alias("n"), F.min(at_start).alias("first"))
    files = counted.groupBy("key").agg(F.min("first")["value"].alias("head"), F.collect_list(F.struct("cells", "n")).alias("held"))
    names = F.transform(F.split(F.regexp_replace("head", "^﻿", ""), _COMMA), lambda c: F.regexp_replace(c, '^ *"|" *$', ""))
    found = listed.join(files, "key", "left").withColumn("header", names)
    total = lambda keep: F.aggregate(F.filter("held", keep), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    found = found.withColumns({"n_lines": F.coalesce(total(lambda x: F.lit(True)) - 1, F.lit(0).cast("long")), "n_wrong": F.coalesce(total(lambda x: x["cells"] != F.size("header")), F.lit(0).cast("long"))})
    plain = F.transform("header", lambda c: F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_")))
    status = F.when(F.col("header").isNull(), "unreadable").when(~F.array_contains(plain, date), "no_date")
    for name in required:
        status = status.when(~F.array_contains(plain, name), f"no_{name}")
    status = status.when(F.col("n_lines") == 0, "no_rows").when(F.col("n_wrong") > 0, "wrong_cells").otherwise("ok")
    return found.select("file", "path", "bytes", "header", "n_lines", "n_wrong", status.alias("status"))


def scan_dated_csv(
    spark: SparkSession, path: str, schema: T.StructType = BARS_CSV, date: str = "date", series_from: str = "partition", manifest: DataFrame | None = None
) -> DataFrame:
    """Every line of the CSV files of all series: ``series_id, date, columns…, rejected_cells``.

    Files are grouped by their header and each group is one scan, so a folder
    may mix layouts; files that ``file_manifest`` (given, or taken here)
    finds unreadable or without a date are left out. Columns are found
    by their header name (case, outer spaces and the difference of space and
    underscore aside), in any order; further columns, such as a calendar's,
    are left out and missing ones stay NULL. Each cell is read on its own:
    one that does not parse is NULL and its column is named in
    ``rejected_cells``; an empty cell is not rejected. A line with another
    number of cells than its header has no values at all and is rejected as
    ``line``. ``series_from`` is
    ``partition`` (``series_id=…`` folders), ``file`` (the file name without
    its ending) or ``column``. A path without files gives no rows.
    """
    if date not in [f.name for f in schema]:
        raise ValueError(f"the schema must name the date column {date!r}")
    manifest = stored(file_manifest(spark, path, date, ()) if manifest is None else manifest, "manifest")
    usable = manifest.where("status NOT IN ('unreadable', 'no_date')")
    layouts = usable.groupBy("header").agg(F.collect_list("path").alias("paths")).limit(MAX_LAYOUTS + 1).collect()
    if len(layouts) > MAX_LAYOUTS:
        raise ValueError(f"{path} has more than {MAX_LAYOUTS} different headers")
    fields = [f for f in schema if f.name not in (date, "series_id")]
    if not layouts:
        return spark.createDataFrame([], T.StructType([T.StructField("series_id", T.StringType()), T.StructField("date", T.DateType()), *fields, T.StructField(_BAD, T.ArrayType(T.StringType()))]))
    scans = [_scan_layout(spark, path, list(r["header"]), r["paths"], fields, date, series_from) for r in layouts]
    return reduce(DataFrame.unionByName, scans)


def _scan_layout(spark: SparkSession, root: str, header: list[str], paths: list[str], fields: list[T.StructField], date: str, series_from: str) -> DataFrame:
    """The files of one header."""
    names = [f"_c{i}" for i in range(len(header))]  # by place: the header is known, and may repeat a name
    columns = [T.StructField(c, T.StringType()) for c in [*names, _LINE]]
    if series_from == "partition":
        columns.append(T.StructField("series_id", T.StringType()))
    reader = spark.read.schema(T.StructType(columns)).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
    reader = reader.option("columnPruning", False)  # else a line's cells are counted among the columns that are asked for
    scan = reader.option("basePath", root).csv(paths)
    whole = F.col(_LINE).isNull()
    found: dict[str, Column] = {}
    for name, place in zip(header, names, strict=True):
        found.setdefault(_header_name(name), F.when(whole, F.trim(F.col(place))))
    if series_from == "file":
        series = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    elif series_from == "partition":
        series = F.col("series_id")
    else:
        series = found.get("series_id", F.lit(None).cast("string"))
    absent = F.lit(None).cast("string")
    texts = {f.name: found.get(f.name, absent) for f in fields}
    cells = {f.name: texts[f.name].try_cast(f.dataType) for f in fields}
    day = F.to_date(lenient_timestamp(found.get(date, absent)))
    unread = lambda t, value: (F.coalesce(t, F.lit("")) != "") & value.isNull()
    bad = [F.when(~whole, F.lit("line"))] + [F.when(unread(texts[c], cells[c]), F.lit(c)) for c in cells] + [F.when(unread(found.get(date, absent), day), F.lit("date"))]
    return scan.select(series.alias("series_id"), day.alias("date"), *[c.alias(n) for n, c in cells.items()], F.array_compact(F.array(*bad)).alias(_BAD))


def read_dated_csv(
    spark: SparkSession, path: str, schema: T.StructType = BARS_CSV, date: str = "date", series_from: str = "partition", manifest: DataFrame | None = None
) -> DataFrame:
    """The dated lines of ``scan_dated_csv``; ``rejected_rows`` reports the rest."""
    return scan_dated_csv(spark, path, schema, date, series_from, manifest).where(F.col("date").isNotNull()).drop(_BAD)


def rejected_rows(scanned: DataFrame) -> DataFrame:
    """Per series what a scan could not use: ``series_id, n_rows, n_undated, n_rejected_cells``."""
    return scanned.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("date").isNull()).alias("n_undated"), F.sum(F.size(_BAD)).alias("n_rejected_cells")
    )


def missing_series(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Series that should have a file and gave no row."""
    return expected.select("series_id").distinct().join(loaded.select("series_id").distinct(), "series_id", "left_anti")


def load_bars(spark: SparkSession, path: str, series_from: str = "partition") -> DataFrame:
    """Bars as written by ``write_panel`` or downloaded: typed, checked, order left to the windows."""
    return require_columns(read_dated_csv(spark, path, series_from=series_from), ["series_id", "date", "close"])


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The frame with aggregates that are taken while it is written."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in metrics.items()]), seen


def _written(spark: SparkSession, path: str, replace: bool, write: Callable[[str], None]) -> None:
    """``write`` to a path; to one that is in use only with ``replace``, and then next to it first, so that a run that fails leaves it."""
    if not (replace and exists(spark, path)):
        write(path)
        return
    staged, old = (f"{path.rstrip('/')}.{name}-{uuid4().hex}" for name in ("staged", "old"))
    write(staged)
    move(spark, path, old)
    move(spark, staged, path)
    remove(spark, old)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None, per_series: bool = False, replace: bool = False) -> None:
    """Rows sorted by series and date, columns in the given order.

    Files hold ranges of (series, date), so their number follows the data, not
    the number of series, and a long series is split. ``per_series`` writes a
    folder for each series instead, which suits few of them. A path in use
    raises, or is replaced as a whole; ``replace_table`` replaces what changed.
    """
    ordered = df.select("series_id", *columns) if columns else df
    dealt = ordered.repartition("series_id") if per_series else ordered.repartitionByRange("series_id", "date")
    writer = dealt.sortWithinPartitions("series_id", "date").write.mode("errorifexists")
    if fmt == "csv":
        writer = writer.option("header", True)
    if per_series:
        writer = writer.partitionBy("series_id")
    _written(df.sparkSession, path, replace, writer.format(fmt).save)


def write_results(leaderboard: DataFrame, path: str, replace: bool = False) -> None:
    """The ranked trials as CSV files of ranges of series, each series' trials together and by rank."""
    writer = leaderboard.repartitionByRange("series_id").sortWithinPartitions("series_id", "rank").write.mode("errorifexists").option("header", True)
    _written(leaderboard.sparkSession, path, replace, writer.csv)


# --- a table that is written again and again ---------------------------------


def _digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per span its rows, first and last date, and a sum of row hashes that no order changes."""
    row = F.xxhash64(*columns)
    return rows.groupBy("span").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.sum(F.pmod(row, F.lit((1 << 31) - 1))).alias("digest"), F.bit_xor(row).alias("mark"),
    )


MANIFEST = "span int, n_rows long, first_day date, last_day date, digest long, mark long"


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def manifest_version(spark: SparkSession, path: str) -> int:
    """The number of the last whole manifest of a table, 0 without one."""
    version = 0
    while exists(spark, f"{_manifests(path)}/{version + 1}/_SUCCESS"):
        version += 1
    return version


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What the last run that ended left in a table: ``span, n_rows, first_day, last_day, digest, mark``."""
    version = manifest_version(spark, path)
    return spark.read.schema(MANIFEST).parquet(f"{_manifests(path)}/{version}") if version else spark.createDataFrame([], MANIFEST)


def replace_table(df: DataFrame, path: str) -> dict[str, int]:
    """Makes the table at ``path`` hold the rows of ``df``; may be run again, over any state of the table.

    Rows lie in folders by ``span`` (the year of ``date``; -1 without one),
    sorted by series and date. They are staged first, so a run that fails in
    computing them changes nothing. Only spans whose rows differ from the
    manifest's are written, in one dynamic overwrite, and spans without rows
    any more are deleted; the rows written are counted on the way and have to
    be the staged ones. The new manifest comes last: a run that fails before
    leaves the old one, and the next run sees what differs and repairs it.

    Returns the number of spans written, deleted and kept.
    """
    spark, columns = df.sparkSession, df.columns
    staged = stored(df.withColumn("span", F.coalesce(F.year("date"), F.lit(-1))), "staged")
    fresh = stored(_digests(staged, columns), "digests")
    old = read_manifest(spark, path)
    same = ["span", "n_rows", "digest", "mark"]
    changed = fresh.join(old.select(*same), same, "left_anti")
    gone = [r["span"] for r in old.join(fresh, "span", "left_anti").select("span").collect()]
    numbers = changed.agg(F.count("span"), F.sum("n_rows")).first()
    if numbers[0]:
        rows = staged.join(changed.select("span"), "span", "left_semi").repartitionByRange("span", "series_id", "date")
        rows, seen = observed(rows.sortWithinPartitions("span", "series_id", "date"), n=F.count(F.lit(1)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("span").parquet(f"{path.rstrip('/')}/data")
        if seen.get["n"] != numbers[1]:
            raise RuntimeError(f"{seen.get['n']} rows were written of {numbers[1]}")
    for span in gone:
        remove(spark, f"{path.rstrip('/')}/data/span={span}")
    version = manifest_version(spark, path)
    if numbers[0] or gone or not version:
        target = f"{_manifests(path)}/{version + 1}"
        fresh.select(*[f.name for f in T.StructType.fromDDL(MANIFEST)]).write.mode("overwrite").parquet(target)
    return {"written": numbers[0], "deleted": len(gone), "kept": fresh.count() - numbers[0]}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table that ``replace_table`` wrote, without their span."""
    if not exists(spark, f"{path.rstrip('/')}/data"):
        return spark.createDataFrame([], schema)
    columns = T.StructType([*schema, T.StructField("span", T.IntegerType())])
    return spark.read.schema(columns).parquet(f"{path.rstrip('/')}/data").drop("span")


def verified_manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The manifest next to the rows there are: ``span, n_rows, first_day, last_day, intact``."""
    there = read_table(spark, path, schema).withColumn("span", F.coalesce(F.year("date"), F.lit(-1)))
    now = _digests(there, [f.name for f in schema]).select("span", *[F.col(c).alias(f"_{c}") for c in ("n_rows", "digest", "mark")])
    intact = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("n_rows", "digest", "mark")])
    return read_manifest(spark, path).join(now, "span", "full").select("span", "n_rows", "first_day", "last_day", intact.alias("intact"))


def order_report(spark: SparkSession, path: str, columns: Mapping[str, str], group: str | None = None) -> DataFrame:
    """Whether the Parquet files of a folder are in order: ``[group,] n_files, n_rows, n_inside, n_across``.

    ``columns`` are the ordering columns and their types, ``group`` a
    partition column within which files, by name, follow each other.
    ``n_inside`` counts rows that come before the row above them in their
    file, ``n_across`` files that begin before the largest row of an earlier
    file. Neighbours are compared inside each file, by a window over its rows;
    between files only their first and last rows are.
    """
    fields = [T.StructField(n, T._parse_datatype_string(t)) for n, t in columns.items()]
    if group:
        fields.append(T.StructField(group, T.IntegerType()))
    rows = spark.read.schema(T.StructType(fields)).parquet(path)
    key = F.struct(*columns)
    rows = rows.select(F.col(group) if group else F.lit(0).alias("_all"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key"))
    own = rows.columns[0]
    above = F.lag("key").over(W.partitionBy("file").orderBy("at"))
    files = rows.withColumn("wrong", (F.col("key") < above).cast("int")).groupBy(own, "file").agg(F.count(F.lit(1)).alias("n"), F.sum("wrong").alias("wrong"), F.min_by("key", "at").alias("first"), F.max("key").alias("largest"))
    before = F.max("largest").over(W.partitionBy(own).orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    files = files.withColumn("late", (F.col("first") < before).cast("int"))
    out = files.groupBy(own).agg(F.count("file").alias("n_files"), F.sum("n").alias("n_rows"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("n_inside"), F.coalesce(F.sum("late"), F.lit(0)).alias("n_across"))
    return out if group else out.drop("_all")


def require_order(report: DataFrame) -> DataFrame:
    """``order_report``'s rows; one with rows out of order raises."""
    wrong = (F.col("n_inside") > 0) | (F.col("n_across") > 0)
    text = F.concat(F.lit("rows out of order: "), F.col("n_inside").cast("string"), F.lit(" inside files, "), F.col("n_across").cast("string"), F.lit(" across files"))
    return report.withColumn("n_rows", F.when(wrong, F.raise_error(text).cast("long")).otherwise(F.col("n_rows")))
