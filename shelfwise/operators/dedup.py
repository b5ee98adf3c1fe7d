"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import ORDER_COLUMNS

#: Groups of keys that `without_superseded` keeps a bound for; some 40 bytes each in
#: every executor. With more keys than groups a bound drops fewer rows, never a wrong one.
GROUPS = 1 << 18


def keep_latest(
    df: DataFrame, key: str = "product_id", order: Sequence[str] = ORDER_COLUMNS
) -> DataFrame:
    """The last row of each key in arrival order; rows without key form one group.

    Order columns the frame lacks are left out. Spark turns the `= 1` filter
    into a group limit on both sides of the shuffle, so a task sends one row
    per key at most, however many rows a hot key has.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in _present(df, order)]
    window = Window.partitionBy(key).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def without_superseded(
    df: DataFrame, key: str = "product_id", order: Sequence[str] = ORDER_COLUMNS, groups: int = GROUPS
) -> DataFrame:
    """Without most rows that a later row of their key supersedes, for `keep_latest`.

    The group limit has to sort whole rows, all that a task reads. Here the newest
    value of the first order column is found by key first, from two columns and by
    hash, and the least of these in each group of keys is a bound: no row below it is
    the newest of any key of the group. Bounds are broadcast, `groups` at most.
    Rows whose bound is NULL (a key without any value) all stay.
    """
    first = F.col(_present(df, order)[0])
    group = F.pmod(F.xxhash64(F.col(key)), F.lit(groups))
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max(first).alias("_newest"))
    group_of_key = F.pmod(F.xxhash64("_key"), F.lit(groups)).alias("_group")
    bounds = newest.groupBy(group_of_key).agg(
        F.when(F.count("_newest") == F.count("*"), F.min("_newest")).alias("_bound")
    )
    bounded = df.withColumn("_group", group).join(F.broadcast(bounds), "_group")
    return bounded.where(F.col("_bound").isNull() | (first >= F.col("_bound"))).drop("_group", "_bound")


def _present(df: DataFrame, order: Sequence[str]) -> list[str]:
    present = [c for c in order if c in df.columns]
    if not present:
        raise ValueError(f"no order column among {list(order)}")
    return present
