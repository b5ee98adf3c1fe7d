"""The raw lake: Parquet, append-only, one directory per hour of arrival."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.union import union_by_name
from shelfwise.schema import ATTEMPT, LAKE_SCHEMA, RAW_COLUMNS
from shelfwise.sources import footers, manifest
from shelfwise.sources.manifest import HOUR_COLUMNS

# Fixed value: the directory layout of foreign lakes, <year>/<month>/<day>/<hour>/.
_HOUR_PATH = r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})/[^/]*$"


def utc_now() -> Column:
    """The current instant as naive UTC, whatever the session's time zone."""
    return _naive_utc(F.unix_micros(F.current_timestamp()))


def _naive_utc(micros: Column) -> Column:
    """Microseconds since 1970 as naive UTC."""
    seconds = micros.cast("decimal(20,0)") / F.lit(1_000_000)
    since_epoch = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch


def with_hour(df: DataFrame, stamp: str = "_ingested_at") -> DataFrame:
    """Adds the hour columns of a timestamp."""
    at = F.col(stamp)
    return df.withColumns(
        dict(zip(HOUR_COLUMNS, [F.year(at), F.month(at), F.dayofmonth(at), F.hour(at)]))
    )


def append_to_lake(df: DataFrame, path: str, many_hours: bool = True, ingest_id: str | None = None) -> None:
    """Appends stamped rows, an hour per directory, and notes them in the lake's log.

    With `many_hours`, the rebalance hint gathers an hour into few files and
    lets adaptive execution split an hour that is larger than others. Rows that
    share one time of arrival are written without a shuffle.

    Known columns are written in the lake's types. Rows that name their attempt
    already are written only; readers see them once the caller notes that attempt.
    """
    spark = df.sparkSession
    if written_by_stream(spark, path):
        raise ValueError(f"{path} belongs to a stream, readers would not see these rows")
    known = {f.name: F.col(f.name).cast(f.dataType) for f in LAKE_SCHEMA.fields if f.name in df.columns}
    hourly = with_hour(df.withColumns(known))
    if ATTEMPT in df.columns:
        _write(hourly, path, many_hours)
        return
    attempt, seen = manifest.new_attempt(), Observation()
    stamp = F.col("_ingested_at")
    # least and greatest stay the same if a task is repeated
    marked = hourly.withColumn(ATTEMPT, F.lit(attempt)).observe(
        seen, F.min(stamp).alias("first"), F.max(stamp).alias("last"), F.coalesce(F.bool_or(stamp.isNull()), F.lit(False)).alias("unstamped")
    )
    _write(marked, path, many_hours)
    directories = manifest.written_directories(spark, path, attempt, **seen.get)
    manifest.commit(spark, path, ingest_id or attempt, attempt, directories, surplus_columns(df.schema))


def _write(hourly: DataFrame, path: str, many_hours: bool) -> None:
    rows = hourly.hint("rebalance", *HOUR_COLUMNS) if many_hours else hourly
    rows.write.mode("append").partitionBy(*HOUR_COLUMNS, ATTEMPT).parquet(path)


def read_lake(spark: SparkSession, *paths: str, since: datetime | None = None) -> DataFrame:
    """The rows of one or more lake directories, optionally from an hour on.

    A lake with a log is read by it: directories of earlier hours are not even
    listed, no footer is read for the schema, and rows of appends that did not
    finish are left out. Columns beyond the known ones are NULL where an append
    lacks them, and text if appends have them in different types. Directories of
    streams are read by the list that their sink keeps.
    """
    frames = [_logged_rows(spark, p, since) if manifest.has_log(spark, p) else _other_rows(spark, p) for p in paths]
    rows = union_by_name(frames)
    return rows if since is None else rows.where(_reached(since))


def _reached(since: datetime) -> Column:
    """Whether an hour is that of an instant or a later one."""
    reached = F.lit(True)
    for column, part in reversed(list(zip(HOUR_COLUMNS, [since.year, since.month, since.day, since.hour]))):
        reached = (F.col(column) > part) | ((F.col(column) == part) & reached)
    return reached


def surplus_columns(schema: T.StructType) -> T.StructType:
    """Columns that the lake's schema does not name."""
    known = {*LAKE_SCHEMA.fieldNames(), *HOUR_COLUMNS, ATTEMPT}
    return T.StructType([f for f in schema.fields if f.name not in known])


def _with_hours(surplus: str) -> str:
    """Columns of a lake's files with some further ones, as they are declared to readers."""
    hours = ", ".join(f"{c} INT" for c in HOUR_COLUMNS)
    return ", ".join(filter(None, [LAKE_SCHEMA.toDDL(), surplus, hours, f"{ATTEMPT} STRING"]))


def _logged_rows(spark: SparkSession, path: str, since: datetime | None) -> DataFrame:
    """One scan for each set of surplus columns that occurs, over the directories of
    its appends. The log's rows are what the driver plans a scan from."""
    log = manifest.read_log(spark, path).where("directory IS NOT NULL")
    entries = (log if since is None else log.where(_reached(since))).select("directory", "surplus").collect()
    groups: dict[tuple, list[str]] = {}
    for directory, surplus in entries:
        groups.setdefault(tuple(tuple(c) for c in surplus), []).append(f"{path.rstrip('/')}/{directory}")
    types: dict[str, set[str]] = {}
    for group in groups:
        for name, kind in group:
            types.setdefault(name, set()).add(kind)
    frames = []
    for group, directories in groups.items():
        declared = _with_hours(", ".join(f"`{name}` {kind}" for name, kind in group))
        rows = spark.read.schema(declared).option("basePath", path).parquet(*sorted(directories))
        frames.append(rows.withColumns({name: F.col(f"`{name}`").cast("string") for name, _ in group if len(types[name]) > 1}))
    if not frames:
        return spark.createDataFrame([], _with_hours("")).drop(ATTEMPT)
    return union_by_name(frames).drop(ATTEMPT)


def _other_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a directory without a log: the files that a stream's sink has listed,
    or Parquet files from elsewhere, which have to agree on their columns' types."""
    found = spark.read.option("mergeSchema", not written_by_stream(spark, path)).parquet(path).schema
    surplus = surplus_columns(found)
    return spark.read.schema(_with_hours(surplus.toDDL() if surplus.fields else "")).parquet(path).drop(ATTEMPT)


def ingest_once(df: DataFrame, path: str, ingest_id: str) -> bool:
    """Appends rows that arrive at one time, unless an ingest of this id has
    finished; says whether it did."""
    if manifest.is_finished(df.sparkSession, path, ingest_id):
        return False
    append_to_lake(df, path, many_hours=False, ingest_id=ingest_id)
    return True


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Whether a streaming sink keeps the list of a directory's files."""
    return manifest.exists(spark, f"{path}/_spark_metadata")


def holds_batch_files(spark: SparkSession, path: str) -> bool:
    return manifest.exists(spark, path) and not written_by_stream(spark, path)


def read_foreign_lake(
    spark: SparkSession, path: str, extra_columns: Sequence[str] = ()
) -> DataFrame:
    """Every Parquet file below a path, columns united by name, absent ones NULL.

    Files written batch by batch differ in their columns and types; a column without
    any value has the type null. Files are put together by the schema that their
    footers state, and each group is one scan by the vectorized reader: columns in
    their own types, then as text, and NULL where the files have no type for them.

    The place of a row in its file and the file's path complete the order of
    arrival. Rows without time of arrival get the hour their path names.
    """
    texts = [*RAW_COLUMNS, *extra_columns]
    wanted = {*texts, "_ingested_at", "_batch_id"}
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for files in footers.files_by_schema(spark, path).values():
        found = spark.read.parquet(files[0]).schema
        typed = T.StructType([f for f in found.fields if f.name in wanted and not isinstance(f.dataType, T.NullType)])
        # files that only lack columns go with those that have them
        key = tuple((f.name, f.dataType.simpleString()) for f in typed.fields)
        groups.setdefault(key, (typed, []))[1].extend(files)
    if not groups:
        raise ValueError(f"no Parquet files below {path}")
    return union_by_name([_foreign_rows(spark, typed, files, texts) for typed, files in groups.values()])


def _foreign_rows(spark: SparkSession, typed: T.StructType, files: list[str], texts: Sequence[str]) -> DataFrame:
    # a schema of its own: a frame without columns has no rows for Spark to read
    rows = spark.read.schema(typed if typed.fields else "product_id STRING").parquet(*files)
    kinds = {f.name: f.dataType for f in typed.fields}

    def column(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`") if name in kinds else F.lit(None)
        return value.try_cast(kind).alias(name)

    file_path = F.col("_metadata.file_path")
    hour = [F.regexp_extract(file_path, _HOUR_PATH, i).try_cast("int") for i in range(1, 5)]
    of_path = F.make_timestamp_ntz(*hour, F.lit(0), F.lit(0))
    stamp = column("_ingested_at", "timestamp_ntz")
    if isinstance(kinds.get("_ingested_at"), T.TimestampType):  # an instant
        stamp = _naive_utc(F.unix_micros("_ingested_at"))
    return rows.select(
        *[column(name, "string") for name in texts],
        F.coalesce(stamp, of_path).alias("_ingested_at"),
        column("_batch_id", "bigint"),
        F.col("_metadata.row_index").alias("_row_id"),
        file_path.alias("_source_file"),
    )


def import_foreign_lake(
    spark: SparkSession, source: str, lake: str, extra_columns: Sequence[str] = ()
) -> None:
    """Appends a foreign lake's rows to the raw lake, arrival times unchanged."""
    append_to_lake(read_foreign_lake(spark, source, extra_columns).drop("_source_file"), lake)


def hour_counts(lake: DataFrame) -> DataFrame:
    """Rows and micro-batches per hour directory."""
    timed = lake if HOUR_COLUMNS[0] in lake.columns else with_hour(lake)
    return (
        timed.groupBy(*HOUR_COLUMNS)
        .agg(F.count("*").alias("rows"), F.count_distinct("_batch_id").alias("batches"))
        .orderBy(*HOUR_COLUMNS)
    )
