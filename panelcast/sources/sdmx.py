"""SDMX-ML generic observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_VALUE = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_value", T.StringType())])

# Element and attribute names below are fixed by the SDMX-ML format.
OBS_SCHEMA = T.StructType(
    [
        T.StructField("generic:ObsKey", T.StructType([T.StructField("generic:Value", T.ArrayType(_VALUE))])),
        T.StructField("generic:ObsValue", T.StructType([T.StructField("_value", T.StringType())])),
    ]
)


def read_sdmx(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``generic:Obs``: period, area and value as text."""
    obs = spark.read.format("xml").option("rowTag", "generic:Obs").schema(OBS_SCHEMA).load(path)
    keys = F.map_from_entries(F.col("`generic:ObsKey`.`generic:Value`"))
    return obs.select(
        keys["TIME_PERIOD"].alias("period"),
        keys["REF_AREA"].alias("area"),
        F.col("`generic:ObsValue`._value").alias("value"),
    )


def write_sdmx(df: DataFrame, path: str, period: Column, area: Column, value: Column) -> None:
    """Text observations as SDMX-ML files, one per partition."""
    entry = lambda name, c: F.struct(F.lit(name).alias("_id"), c.alias("_value"))
    (
        df.select(
            F.struct(F.array(entry("TIME_PERIOD", period), entry("REF_AREA", area)).alias("generic:Value")).alias(
                "generic:ObsKey"
            ),
            F.struct(value.alias("_value")).alias("generic:ObsValue"),
        )
        .write.format("xml")
        .option("rowTag", "generic:Obs")
        .option("rootTag", "message:GenericData")
        .option("validateName", False)
        .save(path)
    )
