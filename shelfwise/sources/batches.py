"""Source order and consecutive micro-batches, without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import scratch_dir

SPLIT_COLUMNS = ["_file", "_block", "_index"]


def with_split(scan: DataFrame) -> DataFrame:
    """A file scan with the file and the block each row was read from, and as
    `_index` its place in the file if the format knows it (Parquet does)."""
    added = {"_file": "file_path", "_block": "file_block_start", "_index": "row_index"}
    known = scan.select("_metadata").schema[0].dataType.names
    return scan.select("*", *[F.col(f"_metadata.{field}").alias(name) for name, field in added.items() if field in known])


def file_starts(rows_of_files: DataFrame, first: int = 0) -> DataFrame:
    """_file, _rows and _start: how many rows come before each file in path order.
    One row for each file, few enough for one task to add up."""
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + F.lit(first).cast("bigint")
    return rows_of_files.select("_file", "_rows", start.alias("_start"))


def rows_of_files(scan: DataFrame) -> DataFrame:
    """_file and _rows of a frame from `with_split` that knows places in files; no
    column of the files is read for that."""
    return scan.groupBy("_file").agg((F.max("_index") + 1).alias("_rows"))


def source_ordinal(scan: DataFrame, name: str = "_ordinal") -> DataFrame:
    """0-based position of each row over all files, in path order.

    Takes a frame from `with_split` that nothing but projections separates from the
    files. Rows of Parquet files know their places there, so the rows of each file
    are counted and its start is added to them; no row is copied or shuffled.
    """
    if "_index" in scan.columns:
        starts = file_starts(rows_of_files(scan))
        numbered = scan.join(starts.select("_file", "_start"), "_file")
        return numbered.withColumn(name, F.col("_start") + F.col("_index")).drop(*SPLIT_COLUMNS, "_start")
    return _counted_ordinal(scan, name)


def _counted_ordinal(scan: DataFrame, name: str) -> DataFrame:
    """The same for files whose rows do not know their places.

    How a scan is cut into splits can change from plan to plan, so the rows are
    written once, with the file and block each was read from and its position in
    that one scan; everything else follows from this table. Rows per block give
    each block's start, and the blocks of a scan partition, few as they are, meet
    its rows by the partition's number. A row that finds no start is an error.
    """
    path = f"{scratch_dir(scan.sparkSession)}/rows"
    scan.withColumn("_position", F.monotonically_increasing_id()).write.parquet(path)
    rows = scan.sparkSession.read.parquet(path)
    partition = F.shiftright("_position", 33).cast("int")
    blocks = rows.groupBy("_file", "_block").agg(F.count("*").alias("_rows"), F.min("_position").alias("_first"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    of_partition = starts.withColumn("_partition", F.shiftright("_first", 33).cast("int")).groupBy("_partition").agg(
        F.array_sort(F.collect_list(F.struct("_first", "_start"))).alias("_blocks")
    )
    own = F.element_at(F.filter("_blocks", lambda b: b["_first"] <= F.col("_position")), -1)
    missing = F.raise_error(F.concat(F.lit("no start for the row at position "), F.col("_position").cast("string")))
    ordinal = F.coalesce(own["_start"] + F.col("_position") - own["_first"], missing.cast("bigint"))
    numbered = rows.drop(*SPLIT_COLUMNS).withColumn("_partition", partition).join(of_partition, "_partition", "left")
    return numbered.withColumn(name, ordinal).drop("_partition", "_position", "_blocks")


def micro_batches(scan: DataFrame, batch_rows: int, first_ordinal: int = 0) -> DataFrame:
    """Rows numbered in source order and cut into batches of `batch_rows`.

    Adds `_row_id` and `_batch_id`. Counting starts at `first_ordinal`.
    """
    numbered = source_ordinal(scan, "_row_id")
    return numbered.withColumn("_row_id", F.col("_row_id") + F.lit(first_ordinal).cast("bigint")).withColumn(
        "_batch_id", F.expr(f"_row_id div {batch_rows:d}")
    )
