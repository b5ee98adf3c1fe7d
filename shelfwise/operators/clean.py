"""Typing, price parsing, fills and validation of raw listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import ListingConfig
from shelfwise.functions import listing, text
from shelfwise.operators.keys import with_number_key
from shelfwise.operators.median import exact_median, merged_median
from shelfwise.schema import (
    METADATA_COLUMNS,
    NO_VALUE,
    NUMERIC_COLUMNS,
    UNKNOWN,
    UNKNOWN_SELLER,
)


def enforce_schema(raw: DataFrame) -> DataFrame:
    """Numeric columns from text, unusable text to NULL. Other columns pass, as
    does an identifier that is a number already."""
    typed = raw.withColumns({c: text.to_number(F.col(c).cast("string")) for c in NUMERIC_COLUMNS})
    if isinstance(raw.schema["product_id"].dataType, T.LongType):
        return typed
    return with_number_key(typed, F.col("product_id").cast("string"), "_product_key").drop("_product_key")


def drop_metadata(df: DataFrame) -> DataFrame:
    """Without the columns that ingestion added."""
    return df.drop(*METADATA_COLUMNS)


def clean_prices(typed: DataFrame) -> DataFrame:
    """Selling price from its text, the list price where there is none."""
    price = text.parse_price(F.col("final_price"))
    return typed.withColumn("final_price", F.coalesce(price, F.col("initial_price")))


def discount_value() -> Column:
    return text.to_number(F.col("discount").cast("string"))


def discount_fill_value(
    raw: DataFrame, conf: ListingConfig = ListingConfig(), counts: DataFrame | None = None
) -> float | None:
    """Value for missing discounts: the median over all raw rows, or 0.0.

    Older versions of a product count, so call it before `keep_latest`. `counts` are
    the raw rows' `value_counts` of the discount where a lake keeps them
    (`sources.summary`); the rows themselves are not read then.
    """
    if conf.discount_fill != "median":
        return 0.0
    return exact_median(raw, discount_value()) if counts is None else merged_median(counts)


def fill_missing(typed: DataFrame, discount: float | None) -> DataFrame:
    """Defaults for missing values; `discount` comes from `discount_fill_value`."""
    score = text.to_number(F.col("what_customers_said").cast("string"))
    return typed.withColumns(
        {
            "discount": F.coalesce(F.col("discount"), F.lit(discount).cast("double")),
            "seller_name": F.coalesce("seller_name", F.lit(UNKNOWN_SELLER)),
            "videos": F.coalesce("videos", F.lit(NO_VALUE)),
            "variations": F.coalesce("variations", F.lit(NO_VALUE)),
            "seller_information": F.coalesce("seller_information", F.lit(UNKNOWN)),
            "what_customers_said": F.coalesce(score, F.lit(0.0)),
        }
    )


def validate(df: DataFrame, conf: ListingConfig = ListingConfig()) -> DataFrame:
    """Ratings limited to the configured range, and whether that changed them;
    missing ratings stay missing."""
    rating = F.col("rating")
    outside = F.coalesce((rating < conf.rating_min) | (rating > conf.rating_max), F.lit(False))
    return df.withColumns(
        {"rating": listing.clamp(rating, conf.rating_min, conf.rating_max), "rating_clamped": outside}
    )
