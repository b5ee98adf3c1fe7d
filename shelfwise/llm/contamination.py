"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are runs of letters and digits of ASCII and of anything beyond ASCII, in
lower case (A to Z only). An item's windows of `n` consecutive words, or all its
words if it has fewer, are the automaton's patterns; a text is brought to the
same form and scanned once, and offsets of what is found are mapped back to the
text as it was given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.frames import extended, plus, texts, written
from shelfwise.llm.hashing import LOWER, byte_set

WINDOW = 10
#: Bytes of item text that one automaton is built of; more items are scanned
#: for in several passes, so an executor never holds more than this.
BLOCK_BYTES = 16 << 20

_word = byte_set([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_folded = np.where(_word, LOWER, 0x20).astype(np.uint8)

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
    ]
)
_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def normal(text: bytes) -> tuple[bytes, np.ndarray]:
    """The words, one blank before each and one after the last, and the place
    in `text` that each byte after the first blank came from."""
    data = np.frombuffer(text, np.uint8)
    kept = _word[data]
    kept[1:] |= kept[:-1].copy()
    at = np.flatnonzero(kept)
    found = _folded[data[at]].tobytes()
    return b" " + found + (b"" if found.endswith(b" ") else b" "), at


def _points(text: bytes) -> np.ndarray:
    """How many code points begin before each byte, and before the end."""
    return np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def patterns(items: Iterable[tuple[str, str | None]], n: int = WINDOW) -> dict[bytes, tuple[int, set[str]]]:
    """For each window in normal form: its number of words, the items it is of."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        words = normal((text or "").encode())[0].split()
        for i in range(max(1, len(words) - n + 1) if words else 0):
            own = words[i : i + n]
            found.setdefault(b" " + b" ".join(own) + b" ", (len(own), set()))[1].add(item)
    return found


def automaton(found: dict[bytes, tuple[int, set[str]]]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for window, (n, items) in found.items():
        machine.add_word(window.decode("latin-1"), (len(window), n, items))
    if len(machine):
        machine.make_automaton()
    return machine


def scan(
    machine, text: bytes, items: Iterable[str] = (), spans: Iterable[tuple[int, int]] = ()
) -> tuple[int, np.ndarray, set[str], list[tuple[int, int]]]:
    """Number of words, which of them are hit, items found, hit spans in code
    points; the items and spans given are taken as found."""
    form, at = normal(text)
    data = np.frombuffer(form, np.uint8)
    blanks = np.flatnonzero(data == 0x20)
    hit, items = np.zeros(len(blanks) - 1 if len(at) else 0, bool), set(items)
    points = None
    for start, end in spans:
        points = _points(text) if points is None else points
        begin = points[at[blanks[:-1]]]
        hit |= (begin >= start) & (begin < end)
    if len(machine) and len(hit):
        for end, (length, n, own) in machine.iter(form.decode("latin-1")):
            first = int(np.searchsorted(blanks, end - length + 1))
            hit[first : first + n] = True
            items |= own
    if not hit.any():
        return len(hit), hit, items, []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    # a word's bytes lie between two blanks of the form, one place further than in `at`
    begin, end = at[blanks[edges[::2]]], at[blanks[edges[1::2]] - 2] + 1
    points = _points(text) if points is None else points
    return len(hit), hit, items, [(int(points[a]), int(points[b])) for a, b in zip(begin, end, strict=True)]


_machines: dict[str, object] = {}


def _scanned(shared, name: str, text: str, again: bool):
    """One pass over the texts; with `again`, what earlier passes found is kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _machines:  # one automaton for each Python worker
            _machines.clear()
            _machines[name] = automaton(patterns(*shared.value))
        for batch in batches:
            before = [()] * batch.num_rows, [()] * batch.num_rows
            if again:
                before = batch.column("item_ids").to_pylist(), batch.column("spans").to_pylist()
                batch = batch.select([c for c in batch.schema.names if c not in FOUND.names])
            values = zip(texts(batch.column(text)), *before, strict=True)
            rows = [scan(_machines[name], t, own, [(s["start"], s["end"]) for s in spans]) for t, own, spans in values]
            yield plus(
                batch,
                {
                    "n_words": pa.array([r[0] for r in rows], pa.int64()),
                    "n_hit": pa.array([int(r[1].sum()) for r in rows], pa.int64()),
                    "item_ids": pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string())),
                    "spans": pa.array([[{"start": a, "end": b} for a, b in r[3]] for r in rows], _spans),
                },
            )

    return run


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with n_words, n_hit (words inside any window found),
    item_ids (sorted as strings) and spans (what is hit, in code points of the
    text, end exclusive). These replace columns of the same names.

    Null texts have no words; items without words, or without an id, are never
    found. Repeated rows are each scanned, repeated items count once. With an
    empty benchmark nothing is hit. The benchmark's size is measured first; it
    is sent to the executors in blocks of items of about `block_bytes` of text,
    one pass over the documents for each, usually one in all.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text")
    ).dropna().distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // block_bytes) or 1
    found, schema = extended(docs, FOUND)
    for i in range(passes):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i).collect()
        shared = spark.sparkContext.broadcast(([tuple(r) for r in own], n))
        name = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        if i:
            found = written(found, f"pass-{i}")
        found = found.mapInArrow(_scanned(shared, name, text, i > 0), schema)
    return found
