"""Snapshots of newest versions, in buckets by the hash of their key.

A snapshot is written as a bucketed table, so Spark reads it as already dealt by its
key: merging it with changes shuffles the changes only. A compaction writes the
buckets that changes touch; all others stay where an earlier one put them. A log has
one entry, one file, for each compaction, with the directory of every bucket.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.manifest import delete, matching

#: Buckets of a snapshot that does not yet exist. A bucket is what one task merges.
BUCKETS = 64
#: How long readers may use what a compaction has replaced.
GRACE_SECONDS = 24 * 3600

BUCKET = "_bucket"
_ENTRY = "position BIGINT, finished_at BIGINT, buckets INT, bucket INT, upto BIGINT"


@dataclass(frozen=True)
class Snapshot:
    """What a compaction left: the last micro-batch it covers, and for each bucket that
    holds rows the micro-batch up to which its directory goes."""

    position: int = -1
    buckets: int = BUCKETS
    upto: dict[int, int] = field(default_factory=dict)
    finished_at: int = 0


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark's bucketed writer gives a key; NULL has one too."""
    return F.pmod(F.hash(F.col(f"`{key}`")), F.lit(buckets))


def snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """The entries of the log, oldest first."""
    files = matching(spark, f"{path}/compacted/position=*/*.parquet")
    if not files:
        return []
    # driver: one row for each bucket and compaction within the grace period
    rows = spark.read.schema(_ENTRY).parquet(*files).collect()
    heads = sorted((r.position, r.finished_at, r.buckets) for r in rows if r.bucket is None)
    return [
        Snapshot(position, buckets, {r.bucket: r.upto for r in rows if r.position == position and r.bucket is not None}, at)
        for position, at, buckets in heads
    ]


def last_snapshot(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Snapshot:
    return (snapshots(spark, path) or [Snapshot(buckets=buckets)])[-1]


def read_buckets(
    spark: SparkSession, path: str, snapshot: Snapshot, schema: T.StructType, key: str, only: list[int] | None = None
) -> DataFrame:
    """The rows of a snapshot, of some buckets only if asked, dealt by their key."""
    held = {b: upto for b, upto in snapshot.upto.items() if only is None or b in only}
    name = _name(path, schema.toDDL(), sorted(held.items()))
    columns = f"{schema.toDDL()}, {BUCKET} INT"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {snapshot.buckets} BUCKETS LOCATION '{path}/snapshots'"
    )
    if held:
        places = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{_place(path, upto, b)}'" for b, upto in held.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    # columns of the table's own name would hide from a union that both its sides are dealt alike
    return spark.table(name).select(*[F.col(f"`{c}`").alias(c) for c in schema.names])


def write_buckets(rows: DataFrame, path: str, before: Snapshot, position: int, touched: list[int], key: str) -> None:
    """Writes the touched buckets anew and notes a snapshot up to `position`.

    A repeated attempt overwrites its own directories; the entry makes it count.
    """
    spark = rows.sparkSession
    target = _name(path, "write", position)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    (
        rows.withColumn(BUCKET, bucket_of(key, before.buckets))
        .write.partitionBy(BUCKET)
        .bucketBy(before.buckets, key)
        .sortBy(key)
        .mode("overwrite")
        .option("path", f"{path}/snapshots/upto={position}")
        .saveAsTable(target)
    )
    spark.sql(f"DROP TABLE {target}")  # its files stay
    upto = {**before.upto, **dict.fromkeys(touched, position)}
    _note(spark, path, Snapshot(position, before.buckets, upto, int(time.time())))


def drop_covered(spark: SparkSession, path: str, grace_seconds: float = GRACE_SECONDS) -> None:
    """Deletes what no reader needs that began within the grace period: changes up to,
    and entries and buckets replaced by, the newest compaction older than that."""
    entries = snapshots(spark, path)
    old = [e for e in entries if e.finished_at <= time.time() - grace_seconds]
    if not old:
        return
    used = {place for e in entries[len(old) - 1 :] for place in e.upto.items()}
    for bucket, upto in {place for e in old for place in e.upto.items()} - used:
        delete(spark, _place(path, upto, bucket))
    for place in matching(spark, f"{path}/changes/epoch=*"):
        if int(place.rpartition("=")[2]) <= old[-1].position:
            delete(spark, place)
    for entry in old[:-1]:  # last, so that an interrupted call is made up for
        delete(spark, _entry(path, entry.position))


def _note(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    head = (snapshot.position, snapshot.finished_at, snapshot.buckets)
    rows = [(*head, None, None), *[(*head, b, upto) for b, upto in snapshot.upto.items()]]
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("overwrite").parquet(_entry(path, snapshot.position))


def _entry(path: str, position: int) -> str:
    return f"{path}/compacted/position={position}"


def _place(path: str, upto: int, bucket: int) -> str:
    return f"{path}/snapshots/upto={upto}/{BUCKET}={bucket}"


def _name(*parts: object) -> str:
    return f"latest_{sha256(repr(parts).encode()).hexdigest()[:24]}"
