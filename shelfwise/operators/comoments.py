"""Means, variances and covariance of two columns, the same for rows in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.exact import exact_total


def comoments(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: mean_x, mean_y, and the sums of squares xx and yy and of products xy
    of what the values differ from the means, over rows that have both values; all
    NULL if there are none.

    Two passes of exact sums, where one over running moments would add doubles as
    they arrive. Differences are taken in units of the greatest value, so that no
    column is too small for the digits that sums keep; xx and xy are scaled back.
    """
    both = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    first = both.agg(
        F.count("*").alias("n"),
        *[exact_total(c).alias(f"sum_{c}") for c in "xy"],
        *[F.max(F.abs(c)).alias(f"unit_{c}") for c in "xy"],
    )
    means = first.select(
        *[(F.col(f"sum_{c}") / F.nullif("n", F.lit(0))).alias(f"mean_{c}") for c in "xy"],
        *[F.when(F.col(f"unit_{c}") == 0, 1.0).otherwise(F.col(f"unit_{c}")).alias(f"unit_{c}") for c in "xy"],
    )
    m = F.col("m")

    def off(c: str) -> Column:
        return (F.col(c) - m[f"mean_{c}"]) / m[f"unit_{c}"]

    centred = both.withColumn("m", means.select(F.struct("*")).scalar()).select("m", off("x").alias("dx"), off("y").alias("dy"))
    sums = centred.agg(
        F.any_value("m").alias("m"),
        exact_total("dx * dx").alias("xx"),
        exact_total("dy * dy").alias("yy"),
        exact_total("dx * dy").alias("xy"),
    )
    return sums.select(
        m["mean_x"].alias("mean_x"),
        m["mean_y"].alias("mean_y"),
        (F.col("xx") * m["unit_x"] * m["unit_x"]).alias("xx"),
        (F.col("yy") * m["unit_y"] * m["unit_y"]).alias("yy"),
        (F.col("xy") * m["unit_x"] * m["unit_y"]).alias("xy"),
    )
