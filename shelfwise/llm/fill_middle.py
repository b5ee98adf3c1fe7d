"""Texts rearranged for training to fill in a middle part, and restored.

A text is cut twice, and the parts stand behind marks: `<P>`prefix`<S>`suffix`<M>`middle
(form `psm`) or `<S>`suffix`<P>`prefix`<M>`middle (`spm`). Each text is one
bytearray: the cuts are found by a scan for the bytes that begin a code point, the
marks are put in where the parts begin, and two neighbouring blocks are exchanged by
three reversals in place. The same exchange, the other way round, restores it.

Which cuts and which form a document gets follows from a hash of its key, so it does
not depend on the partitioning and a repeated task gives the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.frames import chunks, extended, plus, texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes that a reversal or a scan holds beside the text.
STEP = 1 << 16

_COLUMNS = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def reverse(data: np.ndarray, begin: int, end: int) -> None:
    """Reverses a stretch of bytes in place, from both ends inwards."""
    while end - begin > 1:
        step = min(STEP, (end - begin) // 2)
        left = data[begin : begin + step].copy()
        data[begin : begin + step] = data[end - step : end][::-1]
        data[end - step : end] = left[::-1]
        begin, end = begin + step, end - step


def exchange(text: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchanges the blocks before and after `cut` in place."""
    data = np.frombuffer(text, np.uint8)
    reverse(data, begin, cut)
    reverse(data, cut, end)
    reverse(data, begin, end)


def _heads(text: bytes, begin: int) -> np.ndarray:
    """Places of the bytes that begin a code point, in one step of the text."""
    return np.flatnonzero(np.frombuffer(text, np.uint8)[begin : begin + STEP] & 0xC0 != 0x80) + begin


def points(text: bytes) -> int:
    """Code points of a text."""
    return sum(len(_heads(text, at)) for at in range(0, len(text), STEP))


def scan(text: bytes, cuts: list[int]) -> list[int]:
    """Bytes before each of some numbers of code points, in ascending order."""
    found, seen, wanted = [], 0, list(cuts)
    for at in range(0, len(text), STEP):
        heads = _heads(text, at)
        while wanted and wanted[0] < seen + len(heads):
            found.append(int(heads[wanted.pop(0) - seen]))
        seen += len(heads)
    return found + [len(text)] * len(wanted)


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with its middle between two numbers of code points, rearranged."""
    begin, end = scan(text, [first, second])
    data = bytearray(text)
    for at, mark in ((end, SUFFIX), (begin, MIDDLE), (0, PREFIX)):
        data[at:at] = mark
    middle, suffix = begin + 3, end + 6  # where their marks are now
    exchange(data, middle if form == PSM else 0, suffix, len(data))
    return data


def rebuild(output: bytes, form: str) -> bytearray:
    """The text that `arrange` was given."""
    data = bytearray(output)
    if form == PLAIN:
        return data
    begin, cut = (data.find(SUFFIX), data.find(MIDDLE)) if form == PSM else (0, data.find(PREFIX))
    exchange(data, begin, cut, len(data))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = data.find(mark)
        del data[at : at + len(mark)]
    return data


def _numbers(seed: int, key: str | None) -> list[int]:
    """The first four groups of eight digits of a key's hash; no key is an empty one."""
    digits = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    arranged_percent: int = 90,
    spm_percent: int = 20,
) -> DataFrame:
    """Adds n (code points of the text), form, prefix_chars, middle_chars (null
    where the form is `plain`) and output to each row, one row out for each row in.

    A text is left plain if it is empty, if a mark occurs in it, or if the hash of
    its key says so. Null texts are empty ones; rows without a key all get the cuts
    of an empty key; repeated rows get the same result. Columns of the input that
    clash with the added ones are replaced. Memory is a few times the longest text.
    """
    own = {"_cut_key": F.col(f"`{key}`").cast("string")}
    if text.lower() in {name.lower() for name in _COLUMNS.names}:  # an added column will replace it
        own["_cut_text"] = F.col(f"`{text}`")
        text = "_cut_text"
    kept, schema = extended(docs.withColumns(own), _COLUMNS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            rows = []
            for name, data in zip(batch.column("_cut_key").to_pylist(), texts(batch.column(text)), strict=True):
                n = points(data)
                one, two, three, four = _numbers(seed, name)
                if not n or three % 100 >= arranged_percent or any(mark in data for mark in MARKS):
                    rows.append((n, PLAIN, None, None, data))
                    continue
                first, second = sorted((one % (n + 1), two % (n + 1)))
                form = SPM if four % 100 < spm_percent else PSM
                rows.append((n, form, first, second - first, bytes(arrange(data, first, second, form))))
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield plus(
                batch,
                {
                    "n": pa.array(n, pa.int64()),
                    "form": pa.array(form, pa.string()),
                    "prefix_chars": pa.array(prefix, pa.int64()),
                    "middle_chars": pa.array(middle, pa.int64()),
                    "output": pa.array(output, pa.binary()).cast(pa.string()),
                },
            )

    return kept.mapInArrow(run, schema).drop("_cut_key", "_cut_text")


def restore(arranged: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """Adds the text that each output was made of, as `restored`; nothing but the
    output and the form is looked at. A null output is an empty text, a null form
    is `plain`."""
    kept, schema = extended(arranged, T.StructType([T.StructField("restored", T.StringType())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, output):
            forms = batch.column(form).to_pylist()
            found = [bytes(rebuild(t, f or PLAIN)) for t, f in zip(texts(batch.column(output)), forms, strict=True)]
            yield plus(batch, {"restored": pa.array(found, pa.binary()).cast(pa.string())})

    return kept.mapInArrow(run, schema)
