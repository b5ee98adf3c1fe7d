"""Exact median of a column of any size and cardinality."""

from __future__ import annotations

from math import inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 10_000
_MARGIN = 3.0 / _ACCURACY  # of the rows, on both sides; the sketch errs by a third of it


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """v and n: how often each value occurs, NULLs left out. Counts of parts of the
    rows add up to those of all, so they can be kept and merged."""
    return df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.count("*").alias("n"))


def exact_median(df: DataFrame, value: Column, max_values: int = 200_000) -> float | None:
    """Interpolated median, NULLs left out; None when there is no value."""
    return merged_median(df.select(value.cast("double").alias("v"), F.lit(1).cast("bigint").alias("n")), max_values)


def merged_median(counts: DataFrame, max_values: int = 200_000) -> float | None:
    """Interpolated median of values `v` that occur `n` times, in any number of rows
    for each; None when there is no value.

    Counts are merged by value, and these summed up in order. While more than
    `max_values` distinct values remain, a quantile sketch first narrows them to a
    bracket around the middle, which is kept only if counting shows that it holds the
    middle ranks. Every pass reads two columns and returns scalars.
    """
    inside = counts.select("v", "n").where("v IS NOT NULL AND n > 0")
    size, distinct = inside.agg(F.sum("n"), F.approx_count_distinct("v")).first()
    if not size:
        return None
    ranks = ((size - 1) // 2, size // 2)  # 0-based, among the values inside the bracket

    while distinct > max_values:
        quantiles = [max(ranks[0] / size - _MARGIN, 0.0), min(ranks[1] / size + _MARGIN, 1.0)]
        low, high = inside.agg(F.percentile_approx("v", quantiles, _ACCURACY)).first()[0]
        for bracket in ((low, high), (-inf, high), (low, inf)):
            within = F.col("v").between(*bracket)
            smaller, kept, kept_distinct = inside.agg(
                F.coalesce(F.sum(F.when(F.col("v") < bracket[0], F.col("n"))), F.lit(0)),
                F.coalesce(F.sum(F.when(within, F.col("n"))), F.lit(0)),
                F.approx_count_distinct(F.when(within, F.col("v"))),
            ).first()
            if smaller <= ranks[0] and ranks[1] < smaller + kept:
                break
        if low == high == bracket[0] == bracket[1]:
            return low
        if kept == size:
            break
        inside, size, distinct = inside.where(within), kept, kept_distinct
        ranks = (ranks[0] - smaller, ranks[1] - smaller)
    return _at_ranks(inside, ranks)


def _at_ranks(counts: DataFrame, ranks: tuple[int, int]) -> float:
    """Mean of the values at two 0-based ranks, from running value counts."""
    so_far = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        counts.groupBy("v")
        .agg(F.sum("n").alias("n"))
        .select("v", F.sum("n").over(so_far).alias("up_to"))
    )
    picks = [F.min(F.when(F.col("up_to") > rank, F.col("v"))) for rank in ranks]
    lower, upper = running.agg(*picks).first()
    return lower if lower == upper else (lower + upper) / 2
