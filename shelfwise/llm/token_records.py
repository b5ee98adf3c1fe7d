"""Token ids as length-delimited binary records with a separate offset index.

A record is framed as

    8 bytes  length of the payload, little-endian
    4 bytes  masked CRC-32 of those 8 bytes
    payload  key (8 bytes), whether there is one (1 byte: 0 or 1; without, the key
             bytes are 0), width of an id (1 byte: 2 or 4), the ids
    4 bytes  masked CRC-32 of the payload
    1 byte   0x0A

The mask turns a checksum right by 15 bits and adds a constant, so that a frame
stored inside a payload does not carry its own valid checksum. Spark's text
writer writes the frames, so any file system that Spark knows will do and a
repeated task leaves no second copy; the last byte is its line end. A line is as many
frames as LINE_BYTES allow, or one that is longer, and a file as many of the longest
lines as FILE_BYTES allow; so no file is longer than Spark can read as one value,
however many rows share a key.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.encoding import BATCH_BYTES, encoder
from shelfwise.llm.frames import chunks, texts, written

#: Fixed value: the constant that masked checksums in record files add.
MASK = 0xA282EAD8
HEAD, KEY = struct.Struct("<QI"), struct.Struct("<q?B")
FRAME_BYTES = HEAD.size + 4 + 1

#: Bytes of records that the writer takes at once, and of a file; a single longer
#: record makes a line or file of its own.
LINE_BYTES, FILE_BYTES = 1 << 21, 1 << 25
#: Characters of a text that order rows of a key before the text's hash does.
BEGIN = 64

#: `part` numbers files: the task that wrote one, and its place among those of the task.
FILE_BITS = 24
RECORDS = "part long, offset long, length long, key long, n_tokens long, ids binary"
INDEX = "key long, part long, offset long, length long, n_tokens long, start long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without its line end."""
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def record(key: int | None, ids: np.ndarray) -> bytes:
    return frame(KEY.pack(key or 0, key is not None, ids.dtype.itemsize) + ids.tobytes())


def unframe(data: bytes | memoryview, offset: int) -> tuple[bytes, int]:
    """The payload of the record at `offset`, and where the next one begins.
    Raises ValueError if a checksum or the length does not hold."""
    if offset + HEAD.size > len(data):
        raise ValueError(f"record at {offset} is cut off")
    length, crc = HEAD.unpack_from(data, offset)
    if masked_crc(bytes(data[offset : offset + 8])) != crc:
        raise ValueError(f"record at {offset}: length does not match its checksum")
    begin = offset + HEAD.size
    payload = bytes(data[begin : begin + length])
    if len(data) < begin + length + 5 or masked_crc(payload) != struct.unpack_from("<I", data, begin + length)[0]:
        raise ValueError(f"record at {offset}: payload does not match its checksum")
    return payload, begin + length + 5


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, known, width = KEY.unpack_from(payload)
    return key if known else None, np.frombuffer(payload, f"<u{width}", offset=KEY.size)


def _encoded(tokenizer_path: str, end_id: int):
    """Lines of frames."""

    def line(frames: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"\n".join(frames)], pa.binary())], names=["line"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], encode.dtype)
        held, size = [], 0
        for batch in chunks(batches, "text", BATCH_BYTES):
            for key, ids in zip(batch.column("key").to_pylist(), encode.encode(texts(batch.column("text"))), strict=True):
                own = record(key, np.concatenate([ids, end]))
                if held and size + len(own) + 1 > LINE_BYTES:
                    yield line(held)
                    held, size = [], 0
                held.append(own)
                size += len(own) + 1
        if held:
            yield line(held)

    return run


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    missing: bool = False,
) -> None:
    """Writes `path`/records and the index in `path`/index.

    Rows are cut into ranges in ascending order of key and, for repeated keys, of the
    first BEGIN characters of text and then its hash; so files in order of their numbers
    hold all documents in order. Rows that agree in all of these may be in several ranges
    too. A null text is empty, other columns are ignored. Rows without a key are written
    first if `missing`; otherwise they are refused with an error. An empty table gives an
    empty index. Ranges follow `spark.sql.shuffle.partitions` and the advisory partition
    size, files hold FILE_BYTES at most.
    """
    own = F.col(f"`{key}`")
    if not missing:
        own = F.coalesce(own, F.raise_error(F.lit(f"{key} is null")))
    rows = docs.select(own.cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    order = ["key", F.substring("text", 1, BEGIN), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    lines = ordered.mapInArrow(_encoded(tokenizer_path, end_id), "line binary")
    # an id takes four bytes at most and stands for a byte of text at least
    longest = 4 * (rows.agg(F.max(F.octet_length("text"))).first()[0] or 0) + KEY.size + 4 + FRAME_BYTES
    lines_of_file = max(1, FILE_BYTES // max(LINE_BYTES, longest))
    lines.select(F.col("line").cast("string")).write.option("maxRecordsPerFile", lines_of_file).text(f"{path}/records", lineSep="\n")
    _index(docs.sparkSession, path).write.parquet(f"{path}/index")


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of whole files and the ids before each in its file, one output batch
    for some megabytes."""
    schema = pa.schema(
        [(name, pa.int64()) for name in ("part", "offset", "length", "key", "n_tokens")] + [("ids", pa.binary()), ("before", pa.int64())]
    )
    for batch in batches:
        for i in range(batch.num_rows):
            data = memoryview(batch.column("content")[i].as_buffer())
            part, rows, size, offset, before = batch.column("part")[i].as_py(), [], 0, 0, 0
            while offset < len(data):
                payload, following = unframe(data, offset)
                key, ids = parse(payload)
                rows.append((part, offset, following - offset, key, len(ids), ids.astype("<u4").tobytes(), before))
                size += 4 * len(ids)
                before += len(ids)
                offset = following
                if size > 1 << 22 or offset >= len(data):
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    rows, size = [], 0


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    task, place = (F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)[^/]*$", i).cast("long") for i in (1, 2))
    return files.select((F.shiftleft(task, FILE_BITS) + place).alias("part"), "content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record, checksums verified: part, offset, length, key, n_tokens and
    the ids as little-endian unsigned 32-bit integers."""
    return _records(spark, path).drop("before")


def _records(spark: SparkSession, path: str) -> DataFrame:
    return _files(spark, path).mapInArrow(_parsed, f"{RECORDS}, before long")


def _index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record is, and how many ids lie before it: those of its file, as
    its task counted them, and all of earlier files. The window is over one row per file."""
    rows = written(_records(spark, path).drop("ids"), "records")
    files = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select(
        "key", "part", "offset", "length", "n_tokens", (F.col("base") + F.col("before")).alias("start")
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_selected(spark: SparkSession, path: str, selected: DataFrame) -> DataFrame:
    """The records that rows of the index name, each read at its offset, with
    the columns of `read_records`. Each file is read once, however many of its
    records are wanted and in whatever order; a file's wishes are a list that
    is no longer than the file has records."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for offset in row["offsets"]:
                    payload, following = unframe(row["content"], offset)
                    key, ids = parse(payload)
                    found.append((row["part"], offset, following - offset, key, len(ids), ids.astype("<u4").tobytes()))
                names = ["part", "offset", "length", "key", "n_tokens", "ids"]
                types = [*[pa.int64()] * 5, pa.binary()]
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    wishes = selected.groupBy("part").agg(F.collect_list("offset").alias("offsets"))
    return _files(spark, path).join(wishes, "part").mapInArrow(pick, RECORDS)
