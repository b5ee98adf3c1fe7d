"""Document quality by a factorisation machine.

A document is a sparse vector: hashed words (logarithmic counts, unit length),
statistics of its structure, and its length as metadata. The machine adds a
weight for each entry and a product of low-rank factors for each pair of
entries; by the identity of sum of squares, all pairs take time linear in the
entries:  sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.frames import chunks, extended, joined, plus
from shelfwise.llm.hashing import LOWER, byte_set, mix, piece_hashes, run_starts, words

#: Dimensions of hashed words; structure statistics follow them.
BUCKETS = 1 << 16
RANK = 8
#: Labelled rows that a model is fitted on at most, those with the least hash of
#: their id, so a sample that does not depend on the order of rows.
SAMPLE_ROWS = 8000
EPOCHS = 6

_letters = byte_set([*range(65, 91), *range(97, 123), *range(0x80, 0x100), *range(48, 58)])
#: Classes of bytes: lower case, upper case, digit, beyond ASCII, blank, line end, sentence mark, other mark
_class = np.full(256, 7, np.uint8)
_class[97:123], _class[65:91], _class[48:58], _class[128:] = 0, 1, 2, 3
_class[[32, 9]], _class[[10, 13]] = 4, 5
_class[[ord(c) for c in ".,;:'\"-()?"]] = 6
CLASSES = 8
STATISTICS = CLASSES + 7


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # one for each dimension
    factors: np.ndarray  # a row of RANK for each dimension
    centre: np.ndarray  # of the statistics
    scale: np.ndarray


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, dimensions and values of hashed words, and a matrix of statistics,
    for texts whose bytes lie between `offsets`. An empty text has no words and
    statistics of zero."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row_of = np.repeat(np.arange(n), size)
    classes = np.bincount(row_of * CLASSES + _class[data], minlength=n * CLASSES).reshape(n, CLASSES)
    folded = LOWER[data]
    hashes, begin, first = words(folded, offsets, _letters)
    count = np.diff(first)
    word_row = np.repeat(np.arange(n), count)
    keys, repeats = np.unique(word_row * BUCKETS + (hashes >> np.uint64(48)).astype(np.int64), return_counts=True)
    rows, dims = keys // BUCKETS, keys % BUCKETS
    values = np.log1p(repeats)
    values /= np.sqrt(np.bincount(rows, values**2, n))[rows]
    # pairs of neighbouring words, and lines, that occur again in the text
    same = np.flatnonzero(word_row[1:] == word_row[:-1])
    pairs = mix(hashes[same] * np.uint64(3) + hashes[same + 1] + mix(word_row[same].astype(np.uint64)))
    pair_rows = word_row[same][np.unique(pairs, return_index=True)[1]]
    line = data != 10
    starts = run_starts(line, offsets[:-1])
    lines = piece_hashes(folded, line, starts)
    line_row = row_of[np.flatnonzero(starts)] if len(lines) else np.zeros(0, np.int64)
    line_rows = line_row[np.unique(mix(lines + mix(line_row.astype(np.uint64))), return_index=True)[1]]
    distinct = np.bincount(rows, minlength=n)
    statistics = np.column_stack(
        [
            _ratio(classes, size[:, None]),
            np.log1p(size),
            np.log1p(count),
            _ratio(distinct, count),
            _ratio(np.bincount(pair_rows, minlength=n), count - 1),
            _ratio(np.bincount(line_rows, minlength=n), np.bincount(line_row, minlength=n)),
            _ratio(size, count) / 10,
            _ratio(np.maximum.reduceat(np.append(repeats, 0), np.searchsorted(rows, np.arange(n))) * (distinct > 0), count),
        ]
    )
    return rows, dims, values, statistics


def score(model: Model, rows: np.ndarray, dims: np.ndarray, values: np.ndarray, statistics: np.ndarray) -> np.ndarray:
    """The machine's value for each row, before the logistic function."""
    n = len(statistics)
    x = np.clip((statistics - model.centre) / model.scale, -4, 4)
    v, w = model.factors[BUCKETS:], model.weights[BUCKETS:]
    total = model.bias + x @ w + np.bincount(rows, model.weights[dims] * values, n)
    for f in range(model.factors.shape[1]):
        part = model.factors[dims, f] * values
        sums = np.bincount(rows, part, n) + x @ v[:, f]
        total += 0.5 * (sums**2 - np.bincount(rows, part**2, n) - x**2 @ v[:, f] ** 2)
    return total


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(examples: list, labels: np.ndarray, epochs: int = EPOCHS, rank: int = RANK, seed: int = 7) -> Model:
    """Adaptive gradient steps on the logistic loss. An example is (dimensions,
    values, statistics). Without examples every score is one half; with one
    class only, all scores lean to it."""
    random = np.random.default_rng(seed)
    size = BUCKETS + STATISTICS
    model = Model(0.0, np.zeros(size), random.normal(0, 0.02, (size, rank)), np.zeros(STATISTICS), np.ones(STATISTICS))
    if not len(labels):
        return model
    statistics = np.array([e[2] for e in examples])
    model.centre, model.scale = statistics.mean(0), statistics.std(0) + 1e-3
    x_all = np.clip((statistics - model.centre) / model.scale, -4, 4)
    everywhere = np.arange(BUCKETS, size)
    g_w, g_v, g_b = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for batch in np.array_split(order, max(1, len(order) // 64)):
            own = [np.append(examples[i][0], everywhere) for i in batch]
            rows = np.repeat(np.arange(len(batch)), [len(o) for o in own])
            dims = np.concatenate(own)
            x = np.concatenate([np.append(examples[i][1], x_all[i]) for i in batch])
            v = model.factors[dims]
            part = v * x[:, None]
            sums = np.column_stack([np.bincount(rows, part[:, f], len(batch)) for f in range(rank)])
            squares = np.bincount(rows, (part**2).sum(1), len(batch))
            value = model.bias + np.bincount(rows, model.weights[dims] * x, len(batch)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (logistic(value) - labels[batch]) / len(batch)
            used, at = np.unique(dims, return_inverse=True)
            d_w = np.bincount(at, error[rows] * x) + 1e-5 * model.weights[used]
            pull = error[rows][:, None] * x[:, None] * (sums[rows] - part)
            d_v = np.column_stack([np.bincount(at, pull[:, f]) for f in range(rank)]) + 1e-5 * model.factors[used]
            g_b += error.sum() ** 2
            g_w[used] += d_w**2
            g_v[used] += d_v**2
            model.bias -= 0.1 * error.sum() / np.sqrt(g_b)
            model.weights[used] -= 0.1 * d_w / np.sqrt(g_w[used])
            model.factors[used] -= 0.02 * d_v / np.sqrt(g_v[used])
    return model


def _featured(text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            rows, dims, values, statistics = features(*joined(batch.column(text)))
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            arrays = [
                batch.column("key"),
                batch.column("label"),
                pa.array(statistics.tolist(), pa.list_(pa.float64())),
                pa.array([dims[p].astype("<i4").tobytes() for p in parts], pa.binary()),
                pa.array([values[p].astype("<f4").tobytes() for p in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "label", "statistics", "dims", "vals"])

    return run


def sampled(labels: DataFrame, key: str, label: str, usable: Column, rows: int) -> DataFrame:
    """At most `rows` labelled ids: columns key and label, 0 or 1. Rows without
    an id or label are left out; of an id's different labels the least holds."""
    one = labels.where(usable).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    one = one.dropna().groupBy("key").agg(F.min("label").alias("label"))
    return one.orderBy(F.xxhash64("key"), "key").limit(rows)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    key: str = "doc_id",
    label: str = "quality",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
    epochs: int = EPOCHS,
) -> Model:
    """A model fitted on the driver to a sample of at most `rows` labelled
    documents. `usable` is a condition on `labels`."""
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).withColumn("print", F.xxhash64("text"))
    wanted = F.broadcast(sampled(labels, key, label, usable, rows))  # `rows` ids at most
    one = texts.select("key", "print").join(wanted, "key").groupBy("key", "label").agg(F.min("print").alias("print"))
    one = F.broadcast(one)  # one text for each id, if ids are repeated
    schema = "key long, label int, statistics array<double>, dims binary, vals binary"
    rows_of = texts.join(one, ["key", "print"]).select(F.col("key").cast("long"), "label", "text").mapInArrow(_featured("text"), schema)
    found = rows_of.dropDuplicates(["key"]).toArrow().sort_by("key")
    columns = [found.column(c).to_pylist() for c in ("dims", "vals", "statistics")]
    examples = [(np.frombuffer(d, "<i4"), np.frombuffer(v, "<f4"), np.array(s)) for d, v, s in zip(*columns, strict=True)]
    return fit(examples, np.array(found.column("label").to_pylist(), np.float64), epochs)


SCORE = T.StructType([T.StructField("score", T.DoubleType())])


def add_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with a `score` from 0 to 1, higher for better ones, in place
    of any column of that name. Null texts are empty; every row gets a score,
    and equal texts get the same."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kept, schema = extended(docs, SCORE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            value = score(shared.value, *features(*joined(batch.column(text))))
            yield plus(batch, {"score": pa.array(np.round(logistic(value), 9), pa.float64())})

    return kept.mapInArrow(run, schema)
