"""The log of a lake: which directories hold the rows of which finished append.

Every append writes an attempt of its own, one directory in each hour it has rows of
(`…/ingest_hour=7/_attempt=…/`). Once it is complete, one entry is added to the log
beside the lake: a single file, which a rename makes visible as a whole. Readers take
directories and column types from the log. So they open the hours they want only,
read no footers to learn a schema, and never see an attempt that did not finish. An
ingest has an id; if two attempts at one id finish, the one that was first in the log's
order counts, for every reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schema import ATTEMPT

HOUR_COLUMNS = ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]

# Fixed value: how Spark names the directory of a NULL.
_NO_HOUR = "__HIVE_DEFAULT_PARTITION__"

#: One row for each directory of an append, and one without a directory for the append itself.
ENTRY = (
    "ingest_id STRING, attempt STRING, finished_at BIGINT, directory STRING, "
    + ", ".join(f"{c} INT" for c in HOUR_COLUMNS)
    + ", surplus ARRAY<STRUCT<name: STRING, type: STRING>>"
)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or directory; nothing in it is listed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or directory, if there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, as the file system spells them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(status.getPath().toString() for status in found or [])


def log_path(lake: str) -> str:
    return f"{lake.rstrip('/')}_log"


def has_log(spark: SparkSession, lake: str) -> bool:
    return exists(spark, log_path(lake))


def read_log(spark: SparkSession, lake: str) -> DataFrame:
    """The entries of finished appends, one attempt for each ingest."""
    entries = spark.read.schema(ENTRY).parquet(log_path(lake))
    order = Window.partitionBy("ingest_id").orderBy("finished_at", "attempt")
    first = entries.withColumn("_place", F.dense_rank().over(order)).where("_place = 1")
    return first.drop("_place")


def is_finished(spark: SparkSession, lake: str, ingest_id: str) -> bool:
    """Whether an ingest of this id has finished; asked before its source is read."""
    if not has_log(spark, lake):
        return False
    return not spark.read.schema(ENTRY).parquet(log_path(lake)).where(F.col("ingest_id") == ingest_id).isEmpty()


def new_attempt() -> str:
    return uuid.uuid4().hex


def written_directories(
    spark: SparkSession, lake: str, attempt: str, first: datetime | None, last: datetime | None, unstamped: bool = False
) -> list[str]:
    """The directories of an attempt whose rows lie between two instants, and that of
    rows without one. The parts of the hour that both instants share are spelled
    out, so an append to one hour looks at that hour only."""
    hours = [[f"{c}={_NO_HOUR}" for c in HOUR_COLUMNS]] if unstamped else []
    if first is not None:
        known, parts = True, []
        for column, part in zip(HOUR_COLUMNS, ("year", "month", "day", "hour")):
            known = known and getattr(first, part) == getattr(last, part)
            parts.append(f"{column}={getattr(first, part)}" if known else f"{column}=[0-9]*")
        hours.append(parts)
    return [found for parts in hours for found in matching(spark, "/".join([lake.rstrip("/"), *parts, f"{ATTEMPT}={attempt}"]))]


def commit(
    spark: SparkSession, lake: str, ingest_id: str, attempt: str, directories: Iterable[str], surplus: T.StructType
) -> None:
    """Adds the entry of a complete append to the log."""
    rows = [(None, None, None, None, None)]
    for directory in directories:
        values = dict(part.split("=", 1) for part in directory.split("/") if "=" in part)
        hour = [int(values[c]) if values[c].isdigit() else None for c in HOUR_COLUMNS]
        steps = [f"{c}={values[c]}" for c in [*HOUR_COLUMNS, ATTEMPT]]
        rows.append(("/".join(steps), *hour))
    types = [(f.name, f.dataType.simpleString()) for f in surplus.fields]
    entry = [(ingest_id, attempt, None, *row, types) for row in rows]
    stamped = spark.createDataFrame(entry, ENTRY).withColumn("finished_at", F.unix_micros(F.current_timestamp()))
    stamped.coalesce(1).write.mode("append").parquet(log_path(lake))
