"""The named queries: (session, table directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import staging
from shelfwise.functions.sql import register_functions
from shelfwise.operators import clean
from shelfwise.operators.features import add_features
from shelfwise.operators.median import merged_median
from shelfwise.operators.union import union_by_name
from shelfwise.plans import analytics, dashboard, quality, reports, transform, warehouse
from shelfwise.schema import LAKE_SCHEMA, NA_TOKENS
from shelfwise.session import scratch_dir
from shelfwise.sources.batches import micro_batches, with_split
from shelfwise.sources.csv import scan_listing_csv
from shelfwise.sources.lake import append_to_lake, hour_counts, import_foreign_lake, read_lake
from shelfwise.sources.sample_feed import number_forms
from shelfwise.sources.summary import discount_counts, update_summary
from shelfwise.streaming import jobs, messages

Query = Callable[[SparkSession, str], DataFrame]

# How the hours of a foreign lake differ: columns that are missing, further ones, other types.
FOREIGN_KINDS = [
    lambda rows: rows.drop("videos", "_row_id"),
    lambda rows: rows.withColumns({"product_id": F.col("product_id").cast("bigint"), "brand": F.concat(F.lit("b"), "currency")}),
    lambda rows: rows.drop("_ingested_at", "variations").withColumn("rating", F.col("rating").cast("double")),
    lambda rows: rows.withColumns({"_ingested_at": F.col("_ingested_at").cast("string"), "_batch_id": F.col("_batch_id").cast("int")}),
]

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]


# --- sources and ingestion --------------------------------------------------


def src_csv_na_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as CSV text, with every missing-value token, line breaks and
    quotes in its values, read back."""

    def write(path: str) -> None:
        tokens = F.array(*[F.lit(t) for t in [*NA_TOKENS, " NA ", "clip.mp4"]])
        position = (F.col("_batch_id") % (len(NA_TOKENS) + 2) + 1).cast("int")
        title = F.concat("title", F.lit('\n"'), "currency", F.lit('", new'))
        feed = staging.lake(spark, sf_dir).withColumns(
            {"videos": F.element_at(tokens, position), "title": title}
        )
        texts = [F.col(f.name).cast("string").alias(f.name) for f in LAKE_SCHEMA.fields]
        writer = feed.select(*texts).write.option("header", True).option("escape", '"')
        for side in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{side}WhiteSpace", False)
        writer.csv(path)

    path = staging.staged(spark, sf_dir, "csv", write)
    return scan_listing_csv(spark, path).select(
        "_batch_id", "_row_id", "product_id", "title", "ratings_count", "videos", "variations"
    )


def src_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings and the part catalogue, which has other columns."""
    listings = staging.lake(spark, sf_dir).select("product_id", "title", "seller_name", "rating")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_name").alias("title"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("brand"),
    )
    return union_by_name([listings, parts])


def ingest_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_counts(staging.lake(spark, sf_dir).select("_ingested_at", "_batch_id"))


def _hourly_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake with a directory per hour of arrival (here, the first of the month)."""

    def write(path: str) -> None:
        month = F.date_trunc("month", F.col("_ingested_at")).cast("timestamp_ntz")
        append_to_lake(staging.lake(spark, sf_dir).withColumn("_ingested_at", month), path)

    return staging.staged(spark, sf_dir, "hourly", write)


def lake_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hourly lake read from an hour on."""
    return hour_counts(read_lake(spark, _hourly_lake(spark, sf_dir), since=datetime(1996, 5, 1, 0)))


def lake_discount_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fill value of a lake from the counts that are kept beside it."""
    lake = _hourly_lake(spark, sf_dir)
    update_summary(spark, lake)
    fill = merged_median(discount_counts(spark, lake))
    return spark.range(1).select(F.lit(fill).cast("double").alias("fill_value"))


def foreign_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as another writer keeps them, a directory for each hour and columns
    that differ from hour to hour, imported into a lake and read from there."""

    def write(path: str) -> None:
        month = F.date_trunc("month", F.col("_ingested_at")).cast("timestamp_ntz")
        feed = staging.lake(spark, sf_dir).withColumn("_ingested_at", month)
        for hour, kind in enumerate(FOREIGN_KINDS):
            rows = feed.where(F.year("_ingested_at") % len(FOREIGN_KINDS) == hour)
            kind(rows).write.parquet(f"{path}/2024/01/02/{hour:02d}")

    path = staging.staged(spark, sf_dir, "foreign", write)
    lake = staging.staged(spark, sf_dir, "imported", lambda p: import_foreign_lake(spark, path, p, ["brand"]))
    return read_lake(spark, lake).select(
        "product_id", "title", "rating", "videos", "variations", "brand", "_ingested_at", "_batch_id", "ingest_hour"
    )


def numbered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in a directory of several CSV files, numbered in path order."""

    def write(path: str) -> None:
        events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "user_id", "props")
        ordered = events.repartitionByRange(5, "event_id").sortWithinPartitions("event_id")
        ordered.write.option("header", True).option("escape", '"').csv(path)

    path = staging.staged(spark, sf_dir, "csv_files", write)
    return micro_batches(with_split(scan_listing_csv(spark, path)), 50)


def star_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the registered tables."""
    staging.star(spark, sf_dir).register()
    return spark.sql(
        """
        SELECT c.category_name, count(DISTINCT f.seller_name) AS sellers, count(p.title) AS titles,
               count_if(p.has_variations) AS with_variations
        FROM fact_product_listing f JOIN dim_product p USING (product_key) JOIN dim_category c USING (category_slug)
        GROUP BY c.category_name
        """
    )


def micro_batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = with_split(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return micro_batches(scan, 50).select("event_id", "event_type", "_row_id", "_batch_id")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode(messages.encode(staging.lake(spark, sf_dir)))


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in several files, replayed two files at a time."""

    def write(path: str) -> None:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        events.repartitionByRange(5, "event_id").sortWithinPartitions("event_id").write.parquet(path)

    source = staging.staged(spark, sf_dir, "event_files", write)
    schema = spark.read.parquet(source).schema
    out = scratch_dir(spark)
    rows = jobs.file_stream(spark, source, schema, files_per_trigger=2)
    jobs.replay(rows, f"{out}/replay", f"{out}/checkpoint", source=source).awaitTermination()
    replayed = jobs.read_replay(spark, f"{out}/replay", schema)
    return replayed.select(*EVENT_COLUMNS, "_row_id", "_batch_id")


def stream_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = staging.lake_path(spark, sf_dir)
    out = scratch_dir(spark)
    rows = jobs.file_stream(spark, source, LAKE_SCHEMA)
    known = transform.identified(rows)
    jobs.fold_latest(known, f"{out}/latest", f"{out}/checkpoint", "product_key").awaitTermination()
    return jobs.read_latest(spark, f"{out}/latest", known.schema, "product_key")


def stream_latest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest versions of a lake that arrives in two parts, compacted after the first."""
    rows = spark.read.schema(LAKE_SCHEMA).option("recursiveFileLookup", True).parquet(staging.lake_path(spark, sf_dir))
    out = scratch_dir(spark)
    for part in range(2):
        rows.where(F.col("_batch_id") % 2 == part).write.parquet(f"{out}/in/{part}")
        known = transform.identified(jobs.file_stream(spark, f"{out}/in", LAKE_SCHEMA))
        jobs.fold_latest(known, f"{out}/latest", f"{out}/checkpoint", "product_key").awaitTermination()
        if part == 0:
            jobs.compact_latest(spark, f"{out}/latest", known.schema, "product_key", buckets=8)
    return jobs.read_latest(spark, f"{out}/latest", known.schema, "product_key")


# --- cleaning steps ---------------------------------------------------------


def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_metadata(clean.enforce_schema(staging.lake(spark, sf_dir)))


def clean_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.enforce_schema(staging.lake(spark, sf_dir))
    return clean.clean_prices(typed).select("product_id", "initial_price", "final_price", "_batch_id", "_row_id")


def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.enforce_schema(staging.lake(spark, sf_dir))
    return clean.fill_missing(typed, 0.0).select(
        "product_id",
        "seller_name",
        "videos",
        "variations",
        "seller_information",
        "what_customers_said",
        "_batch_id",
        "_row_id",
    )


def fill_discount_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = staging.lake(spark, sf_dir)
    median = clean.discount_fill_value(lake)
    filled = clean.fill_missing(clean.enforce_schema(lake), median)
    return filled.select("product_id", "discount", "_batch_id", "_row_id").withColumn(
        "fill_value", F.lit(median).cast("double")
    )


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = staging.lake(spark, sf_dir)
    typed = clean.clean_prices(clean.enforce_schema(lake))
    return add_features(clean.fill_missing(typed, clean.discount_fill_value(lake)))


def feature_engineering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark, sf_dir).select(
        "product_id",
        "_batch_id",
        "_row_id",
        "discount_amount",
        "is_discounted",
        "price_bucket",
        "ratings_tier",
        "has_seller",
        "has_variations",
        "category_slug",
        "title_word_count",
        "rating_x_count",
    )


def validate_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.enforce_schema(staging.lake(spark, sf_dir))
    return clean.validate(typed).select("product_id", "rating", "_batch_id", "_row_id")


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    typed = clean.enforce_schema(staging.lake(spark, sf_dir))
    return typed.selectExpr(
        "_batch_id",
        "_row_id",
        "clean_price(final_price) AS price",
        "price_bucket(clean_price(final_price)) AS price_bucket",
        "ratings_tier(rating) AS ratings_tier",
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.latest_versions(staging.lake(spark, sf_dir))


def dedup_number_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each product where identifiers are written in many ways."""
    return transform.latest_versions(number_forms(staging.lake(spark, sf_dir))).select(
        "product_key", "product_id", "title", "_batch_id", "_row_id"
    )


def step_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.step_counters(staging.lake(spark, sf_dir), staging.processed(spark, sf_dir))


# ----------------------------------------------------------------------------


def _on_star(report: Callable[[warehouse.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(staging.star(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: getattr(staging.star(spark, sf_dir), name)


def queries() -> dict[str, Query]:
    steps = [
        src_csv_na_normalize,
        src_union_by_name,
        ingest_partition_counts,
        lake_since,
        lake_discount_median,
        foreign_lake,
        star_sql,
        micro_batch_assign,
        numbered_csv,
        json_roundtrip,
        stream_replay,
        stream_dedup_latest,
        stream_latest_compacted,
        enforce_schema,
        clean_prices,
        fill_missing,
        fill_discount_median,
        feature_engineering,
        validate_clamp,
        sql_functions,
        dedup_latest,
        dedup_number_forms,
        step_counters,
    ]
    return {
        **{step.__name__: step for step in steps},
        "processed_listing": staging.processed,
        **{name: _table(name) for name in warehouse.TABLE_SCHEMAS},
        "executive_overview": _on_star(reports.executive_overview),
        "category_performance": _on_star(reports.category_performance),
        "price_segmentation": _on_star(reports.price_segmentation),
        "top_sellers": _on_star(reports.top_sellers),
        "rating_distribution": _on_star(reports.rating_distribution),
        "top_products": _on_star(reports.top_products),
        "discount_effectiveness": _on_star(reports.discount_effectiveness),
        "listing_quality": _on_star(reports.listing_quality),
        "revenue_by_category": _on_star(reports.revenue_by_category),
        "product_sample": _on_star(reports.product_sample),
        "kpi_snapshot": _on_star(analytics.kpi_snapshot),
        "kpi_labels": _on_star(analytics.kpi_labels),
        "top_categories_nb": _on_star(analytics.top_categories),
        "price_bucket_counts": _on_star(analytics.price_bucket_counts),
        "price_bucket_share": _on_star(analytics.price_bucket_share),
        "rating_histogram": _on_star(analytics.rating_histogram),
        "rating_tier_counts": _on_star(analytics.rating_tier_counts),
        "discount_rating_scatter": _on_star(analytics.discount_rating_scatter),
        "discount_rating_trend": _on_star(analytics.discount_rating_trend),
        "discount_rating_corr": _on_star(analytics.discount_rating_corr),
        "top_products_nb": _on_star(analytics.top_products),
        "category_heatmap": _on_star(analytics.category_heatmap),
        "dash_discount_split": _on_star(dashboard.discount_split),
        "dash_scatter": _on_star(dashboard.price_scatter),
        "dash_price_histogram": _on_star(dashboard.price_histogram),
        "dash_category_bucket_matrix": _on_star(dashboard.category_bucket_matrix),
        "dash_category_discount": _on_star(dashboard.category_discount),
        "dash_known_seller_pct": _on_star(dashboard.known_seller_pct),
        "quality_check": _on_star(quality.quality_check),
    }
