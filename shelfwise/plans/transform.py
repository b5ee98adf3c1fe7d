"""Raw listings to the processed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import ListingConfig
from shelfwise.operators.clean import (
    clean_prices,
    discount_fill_value,
    drop_metadata,
    enforce_schema,
    fill_missing,
    validate,
)
from shelfwise.operators.dedup import keep_latest, without_superseded
from shelfwise.operators.features import add_features
from shelfwise.operators.keys import with_number_key
from shelfwise.schema import PROCESSED_SCHEMA


def identified(raw: DataFrame) -> DataFrame:
    """Adds `product_key`, which tells products apart, and makes the identifier a
    number where it is one."""
    return with_number_key(raw, F.col("product_id").cast("string"))


def latest_versions(raw: DataFrame) -> DataFrame:
    """The newest raw row of each product, identified."""
    return keep_latest(without_superseded(identified(raw), "product_key"), "product_key")


def process(
    raw: DataFrame,
    conf: ListingConfig = ListingConfig(),
    newest: DataFrame | None = None,
    discounts: DataFrame | None = None,
) -> DataFrame:
    """Cleaned newest versions with features, one row per product.

    The fill median is taken over all raw rows. All other steps look at one row
    only, so superseded versions are dropped first and never cleaned. Features
    precede validation: they see unclamped ratings. Surplus columns pass.

    `newest` is what `latest_versions(raw)` gives, where a stream keeps it
    (`streaming.jobs.read_latest`), `discounts` the counts of all discounts where a
    lake keeps them (`sources.summary`). With both, nothing of `raw` is read.
    """
    discount = discount_fill_value(raw, conf, discounts)
    if newest is None:
        newest = latest_versions(raw)
    elif "product_key" not in newest.columns:
        newest = identified(newest)
    cleaned = (
        newest.transform(enforce_schema)
        .transform(drop_metadata)
        .transform(clean_prices)
        .transform(lambda df: fill_missing(df, discount))
        .transform(add_features)
        .transform(lambda df: validate(df, conf))
    )
    known = PROCESSED_SCHEMA.fieldNames()
    surplus = [c for c in cleaned.columns if c not in known]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PROCESSED_SCHEMA.fields]
    return cleaned.select(*typed, *surplus)


def step_counters(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows read, duplicates removed, ratings clamped, rows written.

    Counted from the tables, since running counters of a task that is repeated
    after a lost executor would count its rows twice.
    """
    read = raw.agg(F.count("*").alias("raw_rows"))
    written = processed.agg(
        F.count_if("rating_clamped").alias("ratings_clamped"), F.count("*").alias("output_rows")
    )
    return written.select(read.scalar().alias("raw_rows"), "ratings_clamped", "output_rows").select(
        "raw_rows", (F.col("raw_rows") - F.col("output_rows")).alias("duplicates_removed"), "ratings_clamped", "output_rows"
    )
