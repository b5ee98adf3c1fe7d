"""What the footers of Parquet files say, without reading any row."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Files whose footers are read at once, and by how many threads.
_BLOCK, _THREADS = 1000, 32


def files_by_schema(spark: SparkSession, path: str, suffix: str = ".parquet") -> dict[str, list[str]]:
    """Paths of all Parquet files below a path, by the schema in their footers.

    Footers are read in blocks by many threads; the driver keeps paths, as it does
    for any scan, and one schema for each kind of file.
    """
    jvm = spark._jvm
    conf = jvm.org.apache.hadoop.conf.Configuration(spark._jsc.hadoopConfiguration())
    conf.setInt("parquet.metadata.read.parallelism", _THREADS)
    found: dict[str, list[str]] = {}
    for block in _blocks(spark, path, suffix):
        for footer in jvm.org.apache.parquet.hadoop.ParquetFileReader.readAllFootersInParallel(conf, block, True):
            schema = footer.getParquetMetadata().getFileMetaData().getSchema().toString()
            found.setdefault(schema, []).append(footer.getFile().toString())
    return {schema: sorted(files) for schema, files in found.items()}


def _blocks(spark: SparkSession, path: str, suffix: str) -> Iterator[object]:
    """Lists of the files below a path, without those that Spark would not read either."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
    block = spark._jvm.java.util.ArrayList()
    while files.hasNext():
        status = files.next()
        below = status.getPath().toString().split(path.rstrip("/"), 1)[-1].split("/")
        if not below[-1].endswith(suffix) or any(part.startswith((".", "_")) and "=" not in part for part in below):
            continue
        block.add(status)
        if block.size() == _BLOCK:
            yield block
            block = spark._jvm.java.util.ArrayList()
    if block.size():
        yield block
