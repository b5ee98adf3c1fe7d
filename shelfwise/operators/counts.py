"""Counts over a fixed domain and equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domain_counts(
    df: DataFrame, column: str, domain: list[str], keep_absent: bool = True
) -> DataFrame:
    """Rows per label of a fixed domain, in domain order.

    Labels outside the domain are left out. A label that never occurs has a
    NULL count, or no row with `keep_absent=False`.
    """
    labels = df.sparkSession.range(0, len(domain), 1, 1).select(
        F.col("id").alias("rank"),
        F.get(F.array(*[F.lit(label) for label in domain]), F.col("id")).alias(column),
    )
    counts = df.where(F.col(column).isin(domain)).groupBy(column).agg(F.count("*").alias("products"))
    joined = labels.join(counts, column, "left" if keep_absent else "inner")
    return joined.orderBy("rank").select(column, "products")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins from least to greatest value, NULLs left out.

    A bin holds its lower edge; the last one its upper edge too. A constant
    column gets the range value ± 0.5. Columns: bin, lower, upper, count.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col(column).isNotNull())
    limits = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        F.struct(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    span = limits.scalar()
    lo, hi, last = F.col("span.lo"), F.col("span.hi"), bins - 1

    def edge(position: Column) -> Column:
        return F.when(position == bins, hi).otherwise(position * ((hi - lo) / bins) + lo)

    # The quotient may round across an edge; compare with the edges themselves.
    guess = F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(last))
    position = (
        F.when(F.col("x") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("guess") < last) & (F.col("x") >= edge(F.col("guess") + 1)), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counts = (
        values.withColumn("span", span)
        .withColumn("guess", guess)
        .select(position.alias("position"))
        .groupBy("position")
        .agg(F.count("*").alias("n"))
    )
    edges = (
        df.sparkSession.range(0, bins, 1, 1)
        .select(F.col("id").alias("position"), span.alias("span"))
        .where("span.lo is not null")
    )
    return (
        edges.join(counts, "position", "left")
        .select(
            (F.col("position") + 1).cast("int").alias("bin"),
            edge(F.col("position")).alias("lower"),
            edge(F.col("position") + 1).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )
