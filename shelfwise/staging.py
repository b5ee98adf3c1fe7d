"""Tables built once per session and input, then read by many queries.

Reports share the lake, the processed table and the star schema, as they do in
a deployment, rather than each repeating the whole run. The tables are written
to the shared scratch folder, which also cuts the lineage: a lost executor
costs a reader nothing but its own tasks.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.plans.transform import process
from shelfwise.plans.warehouse import Star, read_star, write_star
from shelfwise.schema import LAKE_SCHEMA, PROCESSED_SCHEMA
from shelfwise.session import scratch_dir
from shelfwise.sources.sample_feed import sample_feed

SOURCES = ("lineitem", "part", "supplier")

_paths: dict[tuple, str] = {}
_states: dict[tuple, tuple] = {}
_lock = threading.RLock()


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, size and newest change of the source files; no content is read.

    Looked up once per session and directory; `refresh` looks again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _states:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load([f"{sf_dir}/{name}.parquet" for name in SOURCES])
        )
        state = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime").cast("string"))
        _states[key] = tuple(state.first())
    return _states[key]


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Makes the next query see whether the source files have changed."""
    _states.pop((spark.sparkContext.applicationId, sf_dir), None)


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Path of a table, written by `write(path)` unless this session has it."""
    with _lock:
        key = (spark.sparkContext.applicationId, sf_dir, source_state(spark, sf_dir), name)
        if key not in _paths:
            path = f"{scratch_dir(spark)}/{name}"
            write(path)
            _paths[key] = path
        return _paths[key]


def lake_path(spark: SparkSession, sf_dir: str) -> str:
    return staged(spark, sf_dir, "lake", lambda p: sample_feed(spark, sf_dir).write.parquet(p))


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LAKE_SCHEMA).parquet(lake_path(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staged(
        spark, sf_dir, "processed", lambda p: process(lake(spark, sf_dir)).write.parquet(p)
    )
    return spark.read.schema(PROCESSED_SCHEMA).parquet(path)


def star(spark: SparkSession, sf_dir: str) -> Star:
    path = staged(spark, sf_dir, "star", lambda p: write_star(processed(spark, sf_dir), p))
    return read_star(spark, path)
