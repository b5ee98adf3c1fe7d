"""The scalar functions under SQL names, as SQL expressions (no Python runs)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfwise.functions.listing import PRICE_UPPER_BOUNDS, TIER_LOWER_BOUNDS
from shelfwise.schema import PRICE_BUCKETS, RATING_TIERS, UNKNOWN


def _banded(value: str, labels: list[str], bounds: list[float], compare: str) -> str:
    steps = " ".join(f"WHEN {value} {compare} {b} THEN '{label}'" for label, b in zip(labels, bounds))
    return f"CASE WHEN {value} IS NULL THEN '{UNKNOWN}' {steps} ELSE '{labels[-1]}' END"


def register_functions(spark: SparkSession) -> None:
    """Makes clean_price, price_bucket and ratings_tier callable from SQL."""
    functions = {
        "clean_price(value STRING) RETURNS DOUBLE": (
            "try_cast(regexp_replace(value, '[^0-9.]', '') AS DOUBLE)"
        ),
        "price_bucket(price DOUBLE) RETURNS STRING": _banded(
            "price", PRICE_BUCKETS, PRICE_UPPER_BOUNDS, "<"
        ),
        "ratings_tier(rating DOUBLE) RETURNS STRING": _banded(
            "rating", RATING_TIERS, TIER_LOWER_BOUNDS, ">="
        ),
    }
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
