"""Replay and newest-version streams over files.

All jobs take what is there and stop (`availableNow`), so any scheduler can run
them again; the checkpoint remembers what was read. A micro-batch that is
repeated after a failure overwrites its own output directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.dedup import keep_latest, without_superseded
from shelfwise.schema import ORDER_COLUMNS
from shelfwise.sources.batches import SPLIT_COLUMNS, file_starts, rows_of_files, with_split
from shelfwise.sources.lake import holds_batch_files, utc_now, with_hour
from shelfwise.sources.manifest import HOUR_COLUMNS, exists
from shelfwise.streaming.snapshots import (
    BUCKETS,
    GRACE_SECONDS,
    Snapshot,
    bucket_of,
    drop_covered,
    last_snapshot,
    read_buckets,
    write_buckets,
)

_END = "position BIGINT"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000
) -> DataFrame:
    """Parquet files below a path, oldest first: by time of change, then path."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", True)
        .parquet(path)
    )


def land(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream to the raw lake, stamped with its time of arrival.

    The sink writes every row once and keeps a list of its files, which readers
    follow. Streams and batch jobs therefore need a directory each; `read_lake`
    takes several.
    """
    if holds_batch_files(rows.sparkSession, path):
        raise ValueError(f"{path} holds files of batch jobs, readers would no longer see them")
    stamped = with_hour(rows.withColumn("_ingested_at", utc_now()))
    return (
        stamped.writeStream.format("parquet")
        .partitionBy(*HOUR_COLUMNS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def replay(
    rows: DataFrame, path: str, checkpoint: str, batch_rows: int = 50, source: str | None = None
) -> StreamingQuery:
    """Re-stamps a stream of Parquet files in batches of `batch_rows` rows in path order.

    A list of files is kept next to the output, with the rows of each and the number
    of its first one. A row's number is that and its place in the file, so it does
    not depend on how files come in triggers. Files get their numbers when a replay
    first sees them, those seen at one time in path order: all that `source`, the
    directory behind `rows`, holds when the replay starts; else, or if they arrive
    later, those of a trigger. What the list holds is never changed.
    """
    spark = rows.sparkSession
    if source is not None:
        present = spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(source)
        _list_files(with_split(present), path)

    def write(batch: DataFrame, epoch: int) -> None:
        _list_files(batch, path)
        starts = _listed(batch.sparkSession, path).select("_file", "_start")
        numbered = batch.join(starts, "_file").withColumn("_row_id", F.col("_start") + F.col("_index"))
        stamped = numbered.drop(*SPLIT_COLUMNS, "_start").withColumns(
            {"_batch_id": F.expr(f"_row_id div {batch_rows:d}"), "_ingested_at": utc_now()}
        )
        target = _epoch(f"{path}/rows", epoch)
        stamped.write.mode("overwrite").parquet(target)
        _note(batch.sparkSession, epoch, _epoch(f"{path}/ends", epoch))

    return (
        with_split(rows)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The list of files of a replay."""
    schema = "_file STRING, _rows BIGINT, _start BIGINT"
    if not exists(spark, f"{path}/files"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/files")


def _list_files(rows: DataFrame, path: str) -> None:
    """Adds the files that the list lacks, in one file, so all of them or none."""
    listed = _listed(rows.sparkSession, path)
    new = rows_of_files(rows).join(listed, "_file", "left_anti")
    if new.isEmpty():
        return
    end = listed.agg(F.coalesce(F.max(F.col("_start") + F.col("_rows")), F.lit(0))).first()[0]
    file_starts(new, end).coalesce(1).write.mode("append").parquet(f"{path}/files")


def read_replay(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all micro-batches a replay has finished."""
    added = "_row_id BIGINT, _batch_id BIGINT, _ingested_at TIMESTAMP_NTZ, epoch BIGINT"
    finished = spark.read.schema(f"{_END}, epoch BIGINT").parquet(f"{path}/ends").agg(F.max("epoch"))
    rows = spark.read.schema(f"{schema.toDDL()}, {added}").parquet(f"{path}/rows")
    return rows.where(F.col("epoch") <= finished.scalar()).drop("epoch")


def fold_latest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "product_id",
    order: Sequence[str] = ORDER_COLUMNS,
) -> StreamingQuery:
    """Keeps the newest version per key of a stream.

    A micro-batch writes its own newest rows only. Readers merge these, so
    nothing written before is rewritten, no state grows on the executors, and a
    late row loses against a newer one that came earlier. `compact_latest`
    bounds what readers have to merge.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        target = _epoch(f"{path}/changes", epoch)
        keep_latest(without_superseded(batch, key, order), key, order).write.mode("overwrite").parquet(target)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str = "product_id",
    order: Sequence[str] = ORDER_COLUMNS,
) -> DataFrame:
    """The newest version per key: the last snapshot and the changes since.

    Only the changes are shuffled, into the buckets of the snapshot.
    """
    snapshot = last_snapshot(spark, path)
    return _merged(spark, path, snapshot, _changes(spark, path, schema), schema, key, order)


def compact_latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str = "product_id",
    order: Sequence[str] = ORDER_COLUMNS,
    buckets: int = BUCKETS,
    grace_seconds: float = GRACE_SECONDS,
) -> None:
    """Writes the buckets anew that changes since the last snapshot touch; run it
    between streams.

    The new snapshot counts once it is complete and noted. Changes and buckets that it
    replaces are deleted by the first call after the grace period. `buckets` holds for
    the first snapshot, later ones keep it.
    """
    snapshot = last_snapshot(spark, path, buckets)
    changes = _changes(spark, path, schema)
    new = changes.where(F.col("epoch") > snapshot.position).groupBy(bucket_of(key, snapshot.buckets).alias("bucket"))
    found = new.agg(F.max("epoch").alias("epoch")).collect()  # a row for each bucket at most
    if found:
        touched = [r.bucket for r in found]
        merged = _merged(spark, path, snapshot, changes, schema, key, order, touched)
        write_buckets(merged, path, snapshot, max(r.epoch for r in found), touched, key)
    drop_covered(spark, path, grace_seconds)


def _merged(
    spark: SparkSession,
    path: str,
    snapshot: Snapshot,
    changes: DataFrame,
    schema: T.StructType,
    key: str,
    order: Sequence[str],
    only: list[int] | None = None,
) -> DataFrame:
    """Newest versions of a snapshot, or some of its buckets, and the changes after it."""
    since = changes.where(F.col("epoch") > snapshot.position).drop("epoch")
    if snapshot.position < 0 and only is None:
        return keep_latest(since, key, order)
    held = read_buckets(spark, path, snapshot, schema, key, only)
    return keep_latest(held.unionByName(since.repartition(snapshot.buckets, key)), key, order)


def _changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, f"{path}/changes"):
        return spark.createDataFrame([], f"{schema.toDDL()}, epoch BIGINT")
    return spark.read.schema(f"{schema.toDDL()}, epoch BIGINT").parquet(f"{path}/changes")


def _note(spark: SparkSession, position: int, path: str) -> None:
    note = spark.range(1).select(F.lit(position).cast("bigint").alias("position"))
    note.write.mode("overwrite").parquet(path)


def _epoch(path: str, epoch: int) -> str:
    return f"{path}/epoch={epoch}"
