"""Small helpers the operators share: columns, Arrow batches, scratch tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import scratch_dir

#: Bytes of text that a task looks at in one numpy pass.
CHUNK_BYTES = 1 << 21


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` without columns of these names, whatever their case: an operator's
    own columns replace columns of the input that clash with them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def extended(df: DataFrame, added: T.StructType) -> tuple[DataFrame, T.StructType]:
    """The input without clashing columns, and its schema followed by `added`."""
    kept = without(df, added.names)
    return kept, T.StructType([*kept.schema.fields, *added.fields])


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared scratch folder, read back.

    This cuts the lineage: a lost executor costs later steps their own tasks
    only, and later steps see one evaluation of `df`.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each row begins and
    the last ends; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a part holds about `limit` bytes of a string
    column, or one row if that is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


def plus(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *added.values()], names=[*batch.schema.names, *added]
    )
