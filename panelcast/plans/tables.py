"""The panels read from the given tables."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from panelcast.operators.combine import combine
from panelcast.operators.macro import area_map, parse_macro, routed_macro, with_base_area
from panelcast.sources.ticks import day_bounds, resample_bars

BASE_AREA = "AMERICA"
AREAS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIORITY_AREAS = {p: [a] for p, a in zip(PRIORITIES, AREAS)}
# 5-LOW points at a code no observation has, to exercise the missing-area rule.
PRIORITY_AREAS_WITH_UNKNOWN = PRIORITY_AREAS | {"5-LOW": ["ZZZ"]}



# Stated schemas spare a schema-reading job per scan.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).alias("volume"),
        F.col("o_orderkey").alias("tick_id"),
    )


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_bars(order_ticks(spark, sf_dir), ["tick_id"])


def order_days(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    return day_bounds(order_ticks(spark, sf_dir))


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"), "ts", F.col("value").alias("price"), F.lit(1).alias("volume"), "event_id"
    )
    return resample_bars(ticks, ["ts", "event_id"])


def supplier_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("series_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("volume"),
        "l_orderkey",
        "l_linenumber",
    )


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_bars(supplier_ticks(spark, sf_dir), ["l_orderkey", "l_linenumber"])


def supplier_days(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    return day_bounds(supplier_ticks(spark, sf_dir))


#: Rows of a dense panel that one task holds, about.
TASK_ROWS = 250_000


def panel_tasks(ticks: DataFrame) -> int:
    """How many tasks take a panel with a row for each series and day of the ticks.

    Spark sizes its tasks by the sparse bars that it shuffles; the days come
    after that, inside the task, and there are many times as many.
    """
    found = ticks.agg(F.approx_count_distinct("series_id").alias("series"), F.datediff(F.max("ts"), F.min("ts")).alias("days")).first()
    rows = found["series"] * ((found["days"] or 0) + 1)
    return max(ceil(rows / TASK_ROWS), ticks.sparkSession.sparkContext.defaultParallelism)


def supplier_tasks(spark: SparkSession, sf_dir: str) -> int:
    return panel_tasks(supplier_ticks(spark, sf_dir))


def raw_macro(spark: SparkSession, sf_dir: str, by: str = "region") -> DataFrame:
    """Quarterly growth of order value per region, as text observations.

    ``period`` is ``YYYY-Qn``; the first quarter of an area has no value.
    Values are summed in whole cents, so the result does not depend on how
    the rows are spread. ``by='nation'`` keeps one observation per nation,
    still coded by region.
    """
    t = lambda name: table(spark, sf_dir, name)
    member = ["area"] if by == "region" else ["area", "n_nationkey"]
    quarter = F.trunc("o_orderdate", "quarter").alias("date")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    places = (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_nationkey", F.col("r_name").alias("area"))
    )
    totals = (
        t("orders")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(*member, quarter)
        .agg(F.sum(cents).alias("total"))
    )
    past = F.lag("total").over(W.partitionBy(*member).orderBy("date"))
    growth = (F.col("total") - past) * 100.0 / past
    return totals.select(
        F.format_string("%d-Q%d", F.year("date"), F.quarter("date")).alias("period"), "area", growth.cast("string").alias("value")
    )


def macro_obs(spark: SparkSession, sf_dir: str, by: str = "region") -> DataFrame:
    return parse_macro(raw_macro(spark, sf_dir, by))


def priority_map(spark: SparkSession, sf_dir: str, unknown: bool = False) -> DataFrame:
    """The areas of every priority in the orders; one that the map does not name has the base area."""
    mapping = PRIORITY_AREAS_WITH_UNKNOWN if unknown else PRIORITY_AREAS
    return with_base_area(area_map(spark, mapping), BASE_AREA, order_ticks(spark, sf_dir))


def supplier_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    own = (
        t("supplier")
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").cast("string").alias("series_id"), F.col("r_name").alias("area"), F.lit(0).alias("pos"))
    )
    return with_base_area(own, BASE_AREA)


@dataclass(frozen=True)
class Binding:
    """One panel: its bars, its area map, its calendar and, if many series fill it, its tasks."""

    bars: DataFrame
    areas: DataFrame
    macro: DataFrame
    days: tuple[Column, Column]
    tasks: int | None = None

    def panel(self) -> DataFrame:
        return combine(self.bars, routed_macro(self.areas, self.macro), *self.days, tasks=self.tasks)


def orders_binding(spark: SparkSession, sf_dir: str, unknown: bool = False) -> Binding:
    return Binding(order_bars(spark, sf_dir), priority_map(spark, sf_dir, unknown), macro_obs(spark, sf_dir), order_days(spark, sf_dir))


def supplier_binding(spark: SparkSession, sf_dir: str) -> Binding:
    return Binding(supplier_bars(spark, sf_dir), supplier_map(spark, sf_dir), macro_obs(spark, sf_dir), supplier_days(spark, sf_dir), supplier_tasks(spark, sf_dir))
