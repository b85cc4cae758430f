"""Shared folder handling for checkpoints and written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Without either it is an error, in every mode: only the caller knows a
    folder that all executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several jobs read."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: Spark's setting by which a query's shuffle files go with its end, not with a later collection of the driver's garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that one file of a small table holds, about; and files that such a table has at least, if it comes from as many tasks.
FILE_ROWS, FILES = 20_000, 8


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again.

    Cuts the lineage, so a lost executor costs only its running tasks, and
    tells the planner the frame's true size. ``discard`` deletes the files of
    a frame that nothing reads any more. ``rows``, where the caller knows about
    how many there are, keeps a small table from being a file for each of
    very many tasks.
    """
    if rows is not None:
        df = df.coalesce(max(FILES, -(-rows // FILE_ROWS)))
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the files of frames that came from ``stored``."""
    for df in frames:
        remove(df.sparkSession, df.stored_at)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all that is in it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder inside one file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not found.getFileSystem(spark._jsc.hadoopConfiguration()).rename(found, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} can not become {to}")
