"""The quality gate over the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import ListingConfig
from shelfwise.plans.warehouse import Star

KEYS = {
    "dim_category": "category_slug",
    "dim_seller": "seller_name",
    "dim_product": "product_key",
    "fact_product_listing": "product_key",
}


class QualityError(RuntimeError):
    """A blocking quality check did not pass."""


def _rows(df: DataFrame, table: str, checks: dict[str, tuple[Column, Column, bool]]) -> DataFrame:
    """One aggregate over a table, a row per check: (observed, passed, blocking)."""
    observed = df.agg(*[value.alias(name) for name, (value, _, _) in checks.items()])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            F.col(name).alias("observed"),
            passed.alias("passed"),
            F.lit(blocking).alias("blocking"),
        )
        for name, (_, passed, blocking) in checks.items()
    ]
    return observed.select(F.inline(F.array(*rows)))


def quality_check(star: Star, conf: ListingConfig = ListingConfig()) -> DataFrame:
    """One row per check. Empty tables, repeated keys and orphans block a run;
    missing keys and values out of range are reported only."""

    def none(name: str) -> Column:
        return F.col(name) == 0

    results = []
    for table, key in KEYS.items():
        per_key = getattr(star, table).groupBy(key).agg(F.count("*").alias("n"))
        results.append(
            _rows(
                per_key,
                table,
                {
                    "row_count": (F.coalesce(F.sum("n"), F.lit(0)), F.col("row_count") > 0, True),
                    "repeated_keys": (F.count_if(F.col("n") > 1), none("repeated_keys"), True),
                    "missing_keys": (F.count_if(F.col(key).isNull()), none("missing_keys"), False),
                },
            )
        )
    fact = star.fact_product_listing
    rating_off = ~F.col("rating").between(conf.rating_min, conf.rating_max)
    results.append(
        _rows(
            fact,
            "fact_product_listing",
            {
                "ratings_out_of_range": (F.count_if(rating_off), none("ratings_out_of_range"), False),
                "negative_discounts": (
                    F.count_if(F.col("discount_amount") < 0),
                    none("negative_discounts"),
                    False,
                ),
            },
        )
    )
    for table in ("dim_category", "dim_seller", "dim_product"):
        key = KEYS[table]
        # An anti join would be pushed below the aggregate, to all rows of a key.
        used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        known = getattr(star, table).select(key, F.lit(True).alias("known"))
        name = f"orphans_of_{table}"
        lost = used.join(known, key, "left").where("known is null")
        results.append(
            _rows(
                lost,
                "fact_product_listing",
                {name: (F.coalesce(F.sum("n"), F.lit(0)), none(name), True)},
            )
        )
    return reduce(DataFrame.unionByName, results)


def require_quality(checks: DataFrame) -> None:
    """Raises if a blocking check failed; there is one row per check."""
    failed = checks.where("blocking and not passed").collect()
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.check_name}: {r.observed}" for r in failed))
