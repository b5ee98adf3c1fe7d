"""The whole run: ingest, transform, load, check, publish."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import ListingConfig
from shelfwise.plans.quality import quality_check, require_quality
from shelfwise.plans.transform import identified, process
from shelfwise.plans.warehouse import Star, read_star, write_star
from shelfwise.schema import LAKE_SCHEMA
from shelfwise.sources.batches import micro_batches, with_split
from shelfwise.sources.csv import scan_listing_csv
from shelfwise.sources.lake import ingest_once, read_lake, utc_now
from shelfwise.sources.manifest import is_finished
from shelfwise.sources.summary import discount_counts, update_summary
from shelfwise.streaming import jobs

PUBLISHED_SCHEMA = "run_id string, published_at bigint"


def source_id(spark: SparkSession, source: str) -> str:
    """Names what a source holds by its files' paths, sizes and times of change."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    total = F.sum(each.cast("decimal(20,0)"))
    return files.agg(F.concat_ws("-", F.count("*"), F.sum("length"), total)).first()[0]


def ingest_csv(
    spark: SparkSession,
    source: str,
    lake: str,
    conf: ListingConfig = ListingConfig(),
    multi_line: bool | None = None,
    ingest_id: str | None = None,
) -> bool:
    """Adds a CSV source to the raw lake in numbered micro-batches, once.

    A repeated ingest of the same id, by default that of the source's files,
    changes nothing and does not read the source again; says whether rows were added.
    """
    ingest_id = ingest_id or source_id(spark, source)
    if is_finished(spark, lake, ingest_id):
        return False
    rows = with_split(scan_listing_csv(spark, source, multi_line))
    stamped = micro_batches(rows, conf.batch_rows).withColumn("_ingested_at", utc_now())
    return ingest_once(stamped, lake, ingest_id)


def load(
    spark: SparkSession,
    raw: DataFrame,
    warehouse: str,
    run_id: str,
    conf: ListingConfig = ListingConfig(),
    newest: DataFrame | None = None,
    discounts: DataFrame | None = None,
) -> Star:
    """Processed table and star schema of one run, published once they pass.

    `newest` holds the newest raw versions where a stream keeps them, `discounts` the
    counts of discounts where a lake does, see `process`; else both come from all of
    `raw`.

    Every run writes directories of its own. Readers look up the last published
    run, so they see all tables change at once, and never a run that failed.
    """
    target = f"{warehouse}/runs/{run_id}"
    processed = process(raw, conf, newest, discounts)
    processed.write.mode("overwrite").parquet(f"{target}/processed")
    write_star(spark.read.schema(processed.schema).parquet(f"{target}/processed"), target)
    star = read_star(spark, target)
    require_quality(quality_check(star, conf))
    now = F.unix_micros(F.current_timestamp())
    published = spark.range(1).select(F.lit(run_id).alias("run_id"), now.alias("published_at"))
    published.write.mode("append").parquet(f"{warehouse}/published")
    return star


def published_star(spark: SparkSession, warehouse: str) -> Star:
    """The star schema of the run that was published last."""
    runs = spark.read.schema(PUBLISHED_SCHEMA).parquet(f"{warehouse}/published")
    last = runs.agg(F.max_by("run_id", F.struct("published_at", "run_id"))).first()[0]
    return read_star(spark, f"{warehouse}/runs/{last}")


def run(
    spark: SparkSession,
    source: str,
    lake: str,
    warehouse: str,
    conf: ListingConfig = ListingConfig(),
    now: datetime | None = None,
) -> Star:
    """All stages once; any scheduler may call it, and call it again."""
    started = now or datetime.now(timezone.utc)
    ingest_csv(spark, source, lake, conf)
    run_id = started.strftime("%Y%m%dT%H%M%S%f")
    update_summary(spark, lake)
    star = load(spark, read_lake(spark, lake), warehouse, run_id, conf, discounts=discount_counts(spark, lake))
    star.register()
    return star


def run_landed(
    spark: SparkSession,
    landed: str,
    latest: str,
    checkpoint: str,
    warehouse: str,
    conf: ListingConfig = ListingConfig(),
    now: datetime | None = None,
) -> Star:
    """The hourly run over a lake that `streaming.jobs.land` writes.

    Folds what has landed since the last run into the newest versions kept at `latest`,
    compacts the buckets that it touches and loads from them. Of older rows only the
    discounts are read.
    """
    started = now or datetime.now(timezone.utc)
    rows = identified(jobs.file_stream(spark, landed, LAKE_SCHEMA))
    jobs.fold_latest(rows, latest, checkpoint, "product_key").awaitTermination()
    jobs.compact_latest(spark, latest, rows.schema, "product_key")
    newest = jobs.read_latest(spark, latest, rows.schema, "product_key")
    run_id = started.strftime("%Y%m%dT%H%M%S%f")
    star = load(spark, read_lake(spark, landed), warehouse, run_id, conf, newest)
    star.register()
    return star
