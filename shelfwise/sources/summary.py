"""Counts of the discounts of a lake's rows, kept beside it, append by append.

The fill value is the median over all rows ever received. Counts of values add up, so
an hourly run counts the rows of new appends only and merges these with what earlier
runs have counted; history is not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.clean import discount_value
from shelfwise.schema import ATTEMPT, LAKE_SCHEMA
from shelfwise.sources import manifest

_COUNTS = "attempt STRING, v DOUBLE, n BIGINT"


def summary_path(lake: str) -> str:
    return f"{lake.rstrip('/')}_discounts"


def _kept(spark: SparkSession, lake: str) -> DataFrame:
    path = summary_path(lake)
    if not manifest.exists(spark, path):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(path)


def new_rows(spark: SparkSession, lake: str) -> DataFrame | None:
    """The rows of finished appends that are not counted yet, with their attempts;
    None if there are none."""
    entries = manifest.read_log(spark, lake).where("directory IS NOT NULL")
    counted = _kept(spark, lake).select("attempt").distinct()
    directories = entries.join(counted, "attempt", "left_anti").select("directory").collect()
    if not directories:
        return None
    schema = f"{LAKE_SCHEMA.toDDL()}, {ATTEMPT} STRING"
    paths = sorted(f"{lake.rstrip('/')}/{d}" for (d,) in directories)
    return spark.read.schema(schema).option("basePath", lake).parquet(*paths)


def update_summary(spark: SparkSession, lake: str) -> bool:
    """Counts what is new; says whether there was anything. An append is counted in
    one file, so wholly or not at all; one without any discount has a row of n = 0."""
    rows = new_rows(spark, lake)
    if rows is None:
        return False
    values = rows.select(F.col(ATTEMPT).alias("attempt"), discount_value().alias("v"))
    counts = values.groupBy("attempt", "v").agg(F.count("v").alias("n"))
    counts.coalesce(1).write.mode("append").parquet(summary_path(lake))
    return True


def discount_counts(spark: SparkSession, lake: str) -> DataFrame:
    """v and n over all finished appends, each counted once however often it was."""
    finished = manifest.read_log(spark, lake).select("attempt").distinct()
    once = _kept(spark, lake).join(finished, "attempt", "left_semi").distinct()
    return once.where("v IS NOT NULL").groupBy("v").agg(F.sum("n").alias("n"))
