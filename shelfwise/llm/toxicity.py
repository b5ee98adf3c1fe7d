"""Toxicity by two Kneser-Ney language models that share their backoff counts.

For each class c (toxic, ordinary) and pair of words h w:

    p_c(w | h) = (1 - b(h)) * q_c(w | h) + b(h) * p_c(w)
    q_c(w | h) = max(n_c(h w) - D_c, 0) / n_c(h) + D_c t_c(h) / n_c(h) * q(w | h)
    q(w | h)   = max(n(h w) - D, 0) / (n(h) - D t(h))
    p_c(w)     = max(n_c(w) - D_c, 0) / n_c + D_c t_c / n_c * p(w)
    p(w)       = (number of words that w follows + 1) / (sum of these + vocabulary)
    b(h)       = D t(h) / n(h)

n counts tokens, t distinct successors (or words). The counts of the backoff, for q, b
and p(w), are taken over both classes, so a rare expression weighs the same in both, and
a class of which there is less text is not the likelier one for whatever is new. A class
without h has q for its q_c. A text's value is the difference of its log-likelihoods per
word, over all its words and pairs: those that were counted, however seldom, and those
that were not. With `telling_only`, `train` makes a smaller model instead: p_c(w | h) backs
off to p_c(w) by D_c t_c(h) / n_c(h), without q, and a word or pair whose counts do not
tell the classes apart (by a likelihood-ratio statistic) adds nothing.

Counts are taken by Spark over the labelled documents that are not held
back, see HELD_BACK, each distinct text once. Words are known by 64-bit hashes and pairs by two of them. Pairs are
shuffled once, by their first words; what is counted of a first word is kept with its pairs.
Counts are sent to executors in packed blocks, see `Counted`, and become values there; more
than PASSES blocks are joined with the words of the texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.frames import chunks, extended, joined, plus, without, written
from shelfwise.llm.hashing import LOWER, byte_set, mix, words

#: Word numbers of a `Model`. What `train` makes does not use them.
BITS = 20
VOCABULARY = 1 << BITS
#: Words before: of a row's first word, and of a word by itself.
FIRST, ALONE = 0, 1
#: Least likelihood-ratio statistic of counts that a smaller model keeps apart by class.
#: It is well above what chance gives, as words of repeated passages come in bursts.
SIGNIFICANT = 25.0
#: Words and pairs that an executor's worker holds at once (20 bytes each at most). A larger model is
#: applied in several passes over the documents; their values add up.
BLOCK_PAIRS = 1 << 23
#: Passes up to which a whole model is sent to executors; a larger one is joined.
PASSES = 4
#: Labelled ids up to which labels are broadcast (some 40 bytes each) instead of
#: shuffling the documents to them.
BROADCAST_LABELS = 1 << 20
#: One labelled document in so many is not counted but used to turn values into
#: probabilities; of these at most CALIBRATION_ROWS, by hash of the id.
HELD_BACK = 8
CALIBRATION_ROWS = 4000
CALIBRATION_FILES = 3
#: Pairs that a task packs, and later unpacks, together.
PACKED_PAIRS = 1 << 16
#: Bytes of text that a task looks at in one numpy pass, and texts that it gets at once:
#: little, as it holds a block too.
TEXT_BYTES = 1 << 18
TEXT_ROWS = 1000

_letters = byte_set([*range(65, 91), *range(97, 123), *range(0x80, 0x100), *range(48, 58)])


def word_pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the rows: its row, the hash of the word before (FIRST for
    a row's first word) and its own."""
    word, _, first = words(LOWER[data], offsets, _letters)
    before = np.full_like(word, FIRST)
    before[1:] = word[:-1]
    before[first[:-1][first[:-1] < len(word)]] = FIRST
    return np.repeat(np.arange(len(first) - 1), np.diff(first)), before, word


def pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the rows: its row, and a number for it and the word
    before, which is 0 for a row's first word. For a `Model` only."""
    row, before, word = word_pairs(data, offsets)
    before, word = ((x >> np.uint64(64 - BITS)).astype(np.int64) for x in (before, word))
    return row, before << BITS | word


def term_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One-to-one for a given word, so key and word together say both words."""
    return mix(before + mix(word))


def apart(a: np.ndarray, b: np.ndarray, all_a: np.ndarray, all_b: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of a of all_a against b of all_b."""
    share = (a + b) / np.maximum(all_a + all_b, 1)

    def term(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1) / np.maximum(mean, 1e-12)), 0)

    inside = term(a, all_a * share) + term(b, all_b * share)
    return 2 * (inside + term(all_a - a, all_a * (1 - share)) + term(all_b - b, all_b * (1 - share)))


@dataclass
class Totals:
    """What the probabilities of words need besides a word's own counts; pairs of
    toxic, ordinary."""

    tokens: tuple[float, float]
    types: tuple[float, float]
    discount: tuple[float, float]
    before: float  # sum over words of distinct words before
    vocabulary: int
    shared: float = 0.75  # discount of the counts of both classes

    def word(self, c: int, n: np.ndarray, before: np.ndarray) -> np.ndarray:
        """p_c(w) of words with n tokens in the class."""
        total = max(self.tokens[c], 1)
        left = self.discount[c] * self.types[c] / total if self.tokens[c] else 1.0
        return np.maximum(n - self.discount[c], 0) / total + left * (before + 1.0) / (self.before + self.vocabulary)

    def single(self, n: tuple[np.ndarray, np.ndarray], before: np.ndarray) -> np.ndarray:
        """Log of p_toxic(w) / p_ordinary(w); with no tokens that of an unknown word."""
        return np.log(self.word(0, n[0], before)) - np.log(self.word(1, n[1], before))

    def alone(self, n: tuple[np.ndarray, np.ndarray], before: np.ndarray) -> np.ndarray:
        """As `single`, 0 for words that the classes share."""
        ratio = self.single(n, before)
        return np.where(apart(n[0], n[1], self.tokens[0], self.tokens[1]) >= SIGNIFICANT, ratio, 0.0)

    def pair(self, n, after, types, of_word, before) -> np.ndarray:
        """Difference of log-likelihoods of pairs beyond that of their second
        words. n = tokens of the pair, after and types = tokens and distinct
        words after the first word, of_word = tokens of the second, by class."""
        value = []
        for c in (0, 1):
            direct = np.maximum(n[c] - self.discount[c], 0) / np.maximum(after[c], 1)
            backoff = np.where(after[c] > 0, self.discount[c] * types[c] / np.maximum(after[c], 1), 1.0)
            value.append(np.log(direct + backoff * self.word(c, of_word[c], before)))
        return value[0] - value[1] - self.alone(of_word, before)

    def seen(self, n, after, types, all_types, of_word, before) -> np.ndarray:
        """As `pair`, by the model of all words and pairs, beyond `single`; all_types =
        distinct words after the first word in either class."""
        whole, every = n[0] + n[1], after[0] + after[1]
        left = self.shared * all_types / every
        common = np.maximum(whole - self.shared, 0) / (every - self.shared * all_types)
        value = []
        for c in (0, 1):
            d = self.discount[c]
            own = (np.maximum(n[c] - d, 0) + d * types[c] * common) / np.maximum(after[c], 1)
            direct = np.where(after[c] > 0, own, common)
            value.append(np.log((1 - left) * direct + left * self.word(c, of_word[c], before)))
        return value[0] - value[1] - self.single(of_word, before)


@dataclass
class Model:
    """Values by word numbers: `word` has one for each number, `pairs` is a table
    (key, delta) by the numbers of `pairs()`. Different words can share a number."""

    word: np.ndarray
    pairs: DataFrame
    slope: float = 1.0
    intercept: float = 0.0


@dataclass
class Terms:
    """`terms` is a table (key, word, delta) of words (after ALONE) and pairs by `term_keys`; a smaller model has the words and pairs that tell
    the classes apart. `unknown` is the value of a word that is not in it. What `train`
    makes with `telling_only`."""

    terms: DataFrame
    slope: float = 1.0
    intercept: float = 0.0
    unknown: float = 0.0


@dataclass
class Counted:
    """All words and pairs: `pairs` is a table (h, w, n0, n1, a0, a1, t0, t1, t) with the counts
    of a pair and of its first word, `words` is (w, a0, a1, before). What `train` makes.
    `blocks` are those that were sent to executors; a word and the pairs that end in it are
    in the same one."""

    pairs: DataFrame
    words: DataFrame
    totals: Totals
    slope: float = 1.0
    intercept: float = 0.0
    blocks: list[Broadcast] = field(default_factory=list)


def discounts(repeats: list[tuple[int, int]]) -> tuple[float, float]:
    return tuple(float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.95)) for one, two in repeats)


@dataclass
class Tables:
    word: tuple[np.ndarray, np.ndarray]  # p_c(w)


def estimate(words_of: list[np.ndarray], histories: list[np.ndarray], repeats: list[tuple[int, int]]) -> Tables:
    """Probabilities of all words from arrays: words_of = toxic, ordinary tokens
    and distinct words before; repeats = number of pairs seen once and twice in
    each class."""
    tokens, types = ([f(n) for n in words_of[:2]] for f in (np.sum, np.count_nonzero))
    totals = Totals(tuple(tokens), tuple(types), discounts(repeats), words_of[2].sum(), len(words_of[2]))
    return Tables(tuple(totals.word(c, words_of[c], words_of[2]) for c in (0, 1)))


def _trimmed() -> None:
    """Gives freed memory back: a worker lives on, and its executor has others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with their counts, one row for each pair in some megabytes of text."""

    def out(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        sums = pa.concat_tables(parts).group_by(["h", "w"], use_threads=False).aggregate([("n0", "sum"), ("n1", "sum")])
        sums = sums.select(["h", "w", "n0_sum", "n1_sum"]).rename_columns(["h", "w", "n0", "n1"])
        # in this order the shuffle's compression leaves little more than the second words
        yield from sums.sort_by([("h", "ascending"), ("w", "ascending")]).to_batches()

    held, size = [], 0
    for batch in chunks(batches, "text", TEXT_BYTES):
        row, before, word = word_pairs(*joined(batch.column("text")))
        toxic = np.array(batch.column("label").to_numpy(zero_copy_only=False), np.int64)[row]
        arrays = [pa.array(before.view(np.int64)), pa.array(word.view(np.int64)), pa.array(toxic), pa.array(1 - toxic)]
        held.append(pa.table(arrays, names=["h", "w", "n0", "n1"]))
        size += len(word)
        if size > 1 << 22:
            yield from out(held)
            held, size = [], 0
    if held:
        yield from out(held)
        del held
        _trimmed()


def _columns(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names)


def _hashes(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


def _settled(df: DataFrame, name: str, of_texts: bool = False) -> DataFrame:
    """As `written`; files of the shuffles that lead to it are removed when it is there.
    `of_texts`: executors' workers get few texts at a time, TEXT_ROWS."""
    conf = df.sparkSession.conf
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if of_texts:
        own["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(TEXT_ROWS)
    before = {key: conf.get(key) for key in own}
    try:
        for key, value in own.items():
            conf.set(key, value)
        return written(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def _words_of(counts: DataFrame) -> tuple[DataFrame, Totals]:
    """Counts by word, and the totals of `counts` (h, w, n0, n1)."""
    sums = [F.sum("n0").alias("a0"), F.sum("n1").alias("a1")]
    by_word = _settled(counts.groupBy("w").agg(*sums, F.count("*").alias("before")), "words")
    numbers = [F.col("n0"), F.col("n1"), F.col("n0") + F.col("n1")]
    once = counts.agg(*[F.count_if(number == n) for number in numbers for n in (1, 2)]).first()
    whole = by_word.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("a0", "a1", "before")],
        *[F.count_if(F.col(c) > 0) for c in ("a0", "a1")],
        F.count("*"),
    ).first()
    # one number more than there are words, for all that is unknown
    *discount, shared = discounts([once[:2], once[2:4], once[4:]])
    return by_word, Totals(whole[:2], whole[3:5], tuple(discount), whole[2], whole[5] + 1, shared)


def _sums(counts: DataFrame) -> tuple[DataFrame, DataFrame, Totals]:
    """Counts by word and by history, and the totals of `counts` (h, w, n0, n1)."""
    by_word, totals = _words_of(counts)
    by_history = counts.groupBy("h").agg(
        F.sum("n0").alias("a0"),
        F.sum("n1").alias("a1"),
        F.count_if(F.col("n0") > 0).alias("t0"),
        F.count_if(F.col("n1") > 0).alias("t1"),
    )
    return by_word, by_history, totals


def _with_histories(counts: DataFrame) -> DataFrame:
    """`counts` (h, w, n0, n1) and the counts of first words, in order of h and w. Counts
    that are dealt out by h are not shuffled."""
    of_h = Window.partitionBy("h")
    added = {
        "a0": F.sum("n0").over(of_h),
        "a1": F.sum("n1").over(of_h),
        "t0": F.count_if(F.col("n0") > 0).over(of_h),
        "t1": F.count_if(F.col("n1") > 0).over(of_h),
        "t": F.count("*").over(of_h),
    }
    return counts.sortWithinPartitions("h", "w").withColumns(added)


def _found(before: np.ndarray, word: np.ndarray, delta: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(term_keys(before, word).view(np.int64)), pa.array(word.view(np.int64)), pa.array(delta.astype(np.float32))]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "word", "delta"])


_TERM = "key long, word long, delta float"


def _of_words(by_word: DataFrame) -> DataFrame:
    return by_word.select("w", F.col("a0").alias("w0"), F.col("a1").alias("w1"), "before")


def _all_terms(counts: DataFrame) -> Counted:
    """The model of all words and pairs of `counts` (h, w, n0, n1)."""
    pairs_of = _settled(_with_histories(counts), "pairs", of_texts=True)
    return Counted(pairs_of, *_words_of(pairs_of))


def _unknown(totals: Totals) -> float:
    return float(totals.single((np.zeros(1), np.zeros(1)), np.zeros(1))[0])


def _valued(model: Counted) -> Terms:
    """The values of all words and pairs as a table. Those of a pair and of its second word
    add up to the difference of their log-likelihoods."""
    totals, unknown = model.totals, _unknown(model.totals)

    def singles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1, before = _columns(batch, "a0", "a1", "before")
            word = _hashes(batch, "w")
            yield _found(np.full_like(word, ALONE), word, totals.single((n0, n1), before) - unknown)

    def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, of_h, types, of_w = (_columns(batch, f"{x}0", f"{x}1") for x in ("n", "a", "t", "w"))
            delta = totals.seen(n, of_h, types, *_columns(batch, "t"), of_w, *_columns(batch, "before"))
            yield _found(_hashes(batch, "h"), _hashes(batch, "w"), delta)

    pairs_of = model.pairs.join(_of_words(model.words), "w").mapInArrow(seen, _TERM)
    return Terms(_settled(model.words.mapInArrow(singles, _TERM).union(pairs_of), "terms"), unknown=unknown)


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    table, out = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data, options=pa.ipc.IpcReadOptions(use_threads=False)).read_all().combine_chunks()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def _packer(words: Broadcast):
    """Packs pairs in order of h and w: first words with their counts and numbers of pairs,
    pairs with the numbers that `words` gives to their second words."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        of = {c: table.column(c).to_numpy() for c in table.column_names}
        first = np.flatnonzero(np.append(True, of["h"][1:] != of["h"][:-1]))
        histories = {c: of[c][first] for c in ("h", "a0", "a1", "t0", "t1", "t")}
        histories["pairs"] = np.diff(np.append(first, len(table)))
        number = np.searchsorted(words.value, of["w"]).astype(np.int32)
        parts = _packed(histories), _packed({"number": number, "n0": of["n0"], "n1": of["n1"]})
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], names=["histories", "pairs"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED_PAIRS:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    return run


class Block:
    """Words with the pairs that end in them, packed: on disk and on the way a pair takes
    some 3 bytes. An executor's worker, which gets it by `pickle`, has it unpacked, to 8
    bytes for each pair: `word` and `single`, hashes in order and their values beyond `unknown`; `history`
    and `number`, hashes of first words in order and their numbers; `second` and `deltas`,
    places of the second words of pairs, in order for each first word, and what they add to
    the value of a second word; `start`, where those of each number begin."""

    def __init__(self, words: bytes, parts: list[tuple[bytes, bytes]], totals: Totals):
        self.packed = words, parts, totals

    def __getstate__(self) -> tuple[bytes, list[tuple[bytes, bytes]], Totals]:
        return self.packed

    def __setstate__(self, packed: tuple[bytes, list[tuple[bytes, bytes]], Totals]) -> None:
        _trimmed()
        words, parts, totals = packed
        of = _unpacked(words)
        self.word, self.unknown = of.pop("w"), _unknown(totals)
        single = totals.single((of["a0"].astype(float), of["a1"].astype(float)), of["before"].astype(float))
        self.single = (single - self.unknown).astype(np.float32)
        del single
        _trimmed()
        hashes, sizes = [np.zeros(0, np.int64)], []
        for x, _ in parts:  # unpacked twice, so that all of them are never held at once
            x = _unpacked(x)
            hashes.append(x["h"].copy())
            sizes.append(int(x["pairs"].sum()))
        # a first word whose pairs were packed in two parts keeps its first number
        self.history, number, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.number, numbers = number.astype(np.int32), number[which]
        del hashes, number, which
        _trimmed()
        pairs_of = np.zeros(len(numbers) + 1, np.int64)
        self.second, self.deltas = np.empty(sum(sizes), np.int32), np.empty(sum(sizes), np.float32)
        at = first = 0
        for (x, y), n in zip(parts, sizes):
            x, y = _unpacked(x), _unpacked(y)
            w, pair = y["number"], (y["n0"].astype(float), y["n1"].astype(float))
            of_w, before = (of["a0"][w].astype(float), of["a1"][w].astype(float)), of["before"][w].astype(float)
            a0, a1, t0, t1, t = (np.repeat(x[c].astype(float), x["pairs"]) for c in ("a0", "a1", "t0", "t1", "t"))
            self.second[at : at + n] = w
            self.deltas[at : at + n] = totals.seen(pair, (a0, a1), (t0, t1), t, of_w, before)
            pairs_of[first + 1 : first + 1 + len(x["h"])] = x["pairs"]
            at, first = at + n, first + len(x["h"])
        if (numbers[1:] < numbers[:-1]).any() or len(self.history) < len(numbers):
            # parts of a first word are brought together
            order = np.lexsort((self.second, np.repeat(numbers, pairs_of[1:])))
            self.second, self.deltas = self.second[order], self.deltas[order]
            pairs_of[1:] = np.bincount(numbers, pairs_of[1:], len(numbers)).astype(np.int64)
        self.start = np.cumsum(pairs_of)

    def added(self, number: np.ndarray, second: np.ndarray) -> np.ndarray:
        """`deltas` of pairs of a first word's number and a second word's place, or 0."""
        low, end = self.start[number], self.start[number + 1]
        high, open_ = end.copy(), np.flatnonzero(low < end)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = self.second[middle] < second[open_]
            low[open_[less]], high[open_[~less]] = middle[less] + 1, middle[~less]
            open_ = open_[low[open_] < high[open_]]
        value, inside = np.zeros(len(low)), np.flatnonzero(low < end)
        found = inside[self.second[low[inside]] == second[inside]]
        value[found] = self.deltas[low[found]]
        return value


def _blocks(model: Counted, passes: int) -> list[Broadcast]:
    """The model in so many blocks, by second words; sent once."""
    if len(model.blocks) != passes:
        spark = model.pairs.sparkSession
        model.blocks = []
        for i in range(passes):
            mine = F.pmod(F.col("w"), F.lit(passes)) == i
            words_of = model.words.where(mine).toArrow().sort_by("w").combine_chunks()
            own = spark.sparkContext.broadcast(words_of.column("w").to_numpy())
            packed = model.pairs.where(mine).mapInArrow(_packer(own), "histories binary, pairs binary").toArrow()
            parts = list(zip(packed.column("histories").to_pylist(), packed.column("pairs").to_pylist()))
            columns = {c: words_of.column(c).to_numpy() for c in words_of.column_names}
            model.blocks.append(spark.sparkContext.broadcast(Block(_packed(columns), parts, model.totals)))
            own.destroy()
    return model.blocks


def _terms(counts: DataFrame) -> DataFrame:
    """key, word, delta for the words and pairs of `counts` (h, w, n0, n1) that
    tell the classes apart."""
    by_word, by_history, totals = _sums(counts)

    def alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1, before = _columns(batch, "a0", "a1", "before")
            delta, word = totals.alone((n0, n1), before), _hashes(batch, "w")
            kept = delta != 0
            yield _found(np.full(int(kept.sum()), ALONE, np.uint64), word[kept], delta[kept])

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(apart(*_columns(batch, "n0", "n1", "a0", "a1")) >= SIGNIFICANT))

    def after(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, of_h, types, of_w = (_columns(batch, f"{x}0", f"{x}1") for x in ("n", "a", "t", "w"))
            delta = totals.pair(n, of_h, types, of_w, *_columns(batch, "before"))
            yield _found(_hashes(batch, "h"), _hashes(batch, "w"), delta)

    again = counts.where(F.col("n0") + F.col("n1") >= 2)
    judged = again.join(by_history, "h").select("h", "w", "n0", "n1", "a0", "a1", "t0", "t1")
    telling = written(judged.mapInArrow(kept, judged.schema), "telling")
    of_pairs = telling.join(_of_words(by_word), "w").mapInArrow(after, _TERM)
    return written(by_word.mapInArrow(alone, _TERM).union(of_pairs), "terms")


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    key: str = "doc_id",
    label: str = "toxic",
    text: str = "text",
    telling_only: bool = False,
) -> Terms | Counted:
    """Models from the labelled documents for which `usable`, a condition on
    `labels`, holds; one in HELD_BACK is for calibration only. Rows without id or label are left out; of an id's different
    labels the greatest holds. With no labelled rows every score is one half.
    `telling_only` gives the smaller model."""
    one = labels.where(usable).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    one = one.dropna().groupBy("key").agg(F.max("label").alias("label"))
    back = F.pmod(F.xxhash64("key"), F.lit(HELD_BACK)) == 0
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    prints = texts.select("key", F.xxhash64("text").alias("print"))  # one document for each distinct text
    distinct = prints.join(one.where(~back), "key").groupBy("print", "label").agg(F.min("key").alias("key"))
    counted = written(distinct.select("key", "label"), "counted")
    small = counted.count() <= BROADCAST_LABELS
    rows = texts.join(F.broadcast(counted) if small else counted, "key").select("text", "label")
    parts = rows.mapInArrow(_counted, "h long, w long, n0 long, n1 long")
    # dealt out by first words alone, so that these are counted where their pairs are
    counts = parts.repartition("h").groupBy("h", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    model = Terms(_terms(_settled(counts, "pairs", of_texts=True))) if telling_only else _all_terms(counts)

    sample = one.where(back).orderBy(F.xxhash64(F.lit(1), "key"), "key").limit(CALIBRATION_ROWS)
    # in few files, as each worker that has some of it unpacks the blocks
    own = written(texts.join(F.broadcast(sample), "key").repartition(CALIBRATION_FILES), "sample")
    chosen = add_values(own, model).select("value", "label").toArrow()
    x, y = chosen.column("value").to_numpy(), chosen.column("label").to_numpy().astype(float)
    model.slope, model.intercept = calibrate(x, y)
    return model


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of labels on values, by Newton steps with a weak pull
    to zero. The slope is never negative."""
    if not len(y):
        return 1.0, 0.0
    unit = x.std() or 1.0
    z = np.column_stack([x / unit, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (y - p) - 0.01 * beta
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 0.01 * np.eye(2), gradient)
        beta += np.clip(step, -2, 2)
    return max(float(beta[0]) / unit, 0.0), float(beta[1])


VALUE = T.StructType([T.StructField("value", T.DoubleType())])


def _parts(before: np.ndarray, word: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The terms whose values a word of a text adds up."""
    return [(np.full_like(word, ALONE), word), (before, word)]


def _numbered(word: np.ndarray, table: pa.Table):
    """Values of the words of texts by a `Model`."""
    keys, deltas = table.column("key").to_numpy(), table.column("delta").to_numpy()

    def values(data: np.ndarray, offsets: np.ndarray, again: bool) -> tuple[np.ndarray, np.ndarray]:
        row, key = pairs(data, offsets)
        value = np.zeros(len(key)) if again else word[key & (VOCABULARY - 1)].astype(float)
        if len(keys):
            distinct, which = np.unique(key, return_inverse=True)
            at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
            value += np.where(keys[at] == distinct, deltas[at], 0)[which]
        return row, value

    return values


def _told(table: pa.Table, unknown: float):
    """Values of the words of texts by `Terms`."""
    keys, own, deltas = (table.column(c).to_numpy() for c in ("key", "word", "delta"))

    def values(data: np.ndarray, offsets: np.ndarray, again: bool) -> tuple[np.ndarray, np.ndarray]:
        row, before, word = word_pairs(data, offsets)
        value = np.full(len(word), 0.0 if again else unknown)
        if len(keys):
            for h, w in _parts(before, word):
                distinct, first, which = np.unique(term_keys(h, w).view(np.int64), return_index=True, return_inverse=True)
                at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
                same = (keys[at] == distinct) & (own[at] == w.view(np.int64)[first])
                value += np.where(same, deltas[at], 0)[which]
        return row, value

    return values


def _counted_values(block: Block, part: int, passes: int):
    """Values of the words of texts by a block of a `Counted`; 0 for words of other blocks."""

    def places(sorted_: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(sorted_, asked), len(sorted_) - 1)
        return at, sorted_[at] == asked

    def values(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, before, own = word_pairs(data, offsets)
        value = np.zeros(len(own))
        mine = np.flatnonzero(own.view(np.int64) % passes == part)
        distinct, which = np.unique(own[mine].view(np.int64), return_inverse=True)
        place, known = places(block.word, distinct)
        of_words = np.full(len(distinct), block.unknown)
        of_words[known] += block.single[place[known]]
        value[mine] = of_words[which]
        first, of_first = np.unique(before[mine].view(np.int64), return_inverse=True)
        at, seen = places(block.history, first)
        both = np.flatnonzero(known[which] & seen[of_first])
        if len(both):
            value[mine[both]] += block.added(block.number[at[of_first[both]]], place[which[both]])
        return row, value

    return values


def add_values(docs: DataFrame, model: Model | Terms | Counted, text: str = "text") -> DataFrame:
    """The documents with `value`: toxic minus ordinary log-likelihood per word,
    in place of any column of that name; 0 for texts without words.

    With a `Counted`, several passes or a join, values are added up by text (its 64-bit
    hash), so texts are neither written nor shuffled; those of a `Counted` are written."""
    kept, schema = extended(docs, VALUE)
    size = sum(t.count() for t in _tables(model))  # of a `Counted` words twice, as they are first words too
    passes = max(1, -(-size // BLOCK_PAIRS))
    counted = isinstance(model, Counted)
    if passes == 1 and not counted:
        return kept.mapInArrow(_pass(model, 0, 1, text, schema.names), schema)
    printed = kept.select(F.xxhash64(f"`{text}`").alias("_print"), F.col(f"`{text}`"))
    if passes > PASSES and not isinstance(model, Model):
        values = _joined_values(printed, _valued(model) if counted else model, text)
    else:
        parts = None
        for i in range(passes):
            part = printed.mapInArrow(_pass(model, i, passes, text, ["_print", "value"]), "_print long, value double")
            parts = part if parts is None else parts.union(part)
        # each pass has a row for each copy of a text
        values = parts.groupBy("_print").agg((F.sum("value") * passes / F.count("*")).alias("value"))
        values = _settled(values, "values", of_texts=True) if counted else values
    return kept.withColumn("_print", F.xxhash64(f"`{text}`")).join(values, "_print").drop("_print")


def _tables(model: Model | Terms | Counted) -> list[DataFrame]:
    if isinstance(model, Counted):
        return [model.words, model.words, model.pairs]
    return [model.pairs if isinstance(model, Model) else model.terms]


def _pass(model: Model | Terms | Counted, part: int, passes: int, text: str, names: list[str]):
    """Adds to texts what the terms of a block give; `names` are the columns to return."""
    if isinstance(model, Counted):
        block = _blocks(model, passes)[part]

        def prepared():
            values = _counted_values(block.value, part, passes)
            _trimmed()
            return values
    else:
        table = _tables(model)[0]
        own = table.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == part).toArrow().sort_by("key").combine_chunks()
        numbered = isinstance(model, Model)
        block = table.sparkSession.sparkContext.broadcast((model.word if numbered else None, own))
        unknown = 0.0 if numbered else model.unknown

        def prepared():
            word, own = block.value
            values = _told(own, unknown) if word is None else _numbered(word, own)
            return lambda data, offsets: values(data, offsets, part > 0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = prepared()
        for batch in chunks(batches, text, TEXT_BYTES):
            row, value = values(*joined(batch.column(text)))
            n = np.maximum(np.bincount(row, minlength=batch.num_rows), 1)
            total = np.bincount(row, value, batch.num_rows) / n
            yield plus(batch, {"value": pa.array(total, pa.float64())}).select(names)

    return run


def _joined_values(printed: DataFrame, model: Terms, text: str) -> DataFrame:
    """_print, value of texts, by a join of their terms with those of the model."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            row, before, word = word_pairs(*joined(batch.column(text)))
            prints = batch.column("_print").to_numpy()
            share = 1 / np.maximum(np.bincount(row, minlength=batch.num_rows), 1)
            for h, w in _parts(before, word):
                arrays = [prints[row], term_keys(h, w).view(np.int64), w.view(np.int64), share[row]]
                terms = pa.table([pa.array(a) for a in arrays], names=["_print", "key", "word", "share"])
                sums = terms.group_by(["_print", "key", "word"], use_threads=False).aggregate([("share", "sum")])
                yield from sums.select(["_print", "key", "word", "share_sum"]).rename_columns(terms.column_names).to_batches()

    terms = printed.mapInArrow(run, "_print long, key long, word long, share double")
    told = terms.join(model.terms, ["key", "word"]).groupBy("_print").agg(F.sum(F.col("share") * F.col("delta")).alias("told"))
    empty = F.lit(0.0)
    unknown = F.when(F.max(_has_words(text)), F.lit(model.unknown)).otherwise(empty)
    copies = printed.groupBy("_print").agg(F.count("*").alias("copies"), unknown.alias("unknown"))
    value = F.col("unknown") + F.coalesce(F.col("told") / F.col("copies"), empty)
    return copies.join(told, "_print", "left").select("_print", value.alias("value"))


def _has_words(text: str) -> Column:
    """Whether a text has any byte of `_letters`."""
    return F.coalesce(F.col(f"`{text}`").rlike("[0-9A-Za-z]|[^\\x00-\\x7F]"), F.lit(False))


def add_scores(docs: DataFrame, model: Model | Terms | Counted, text: str = "text") -> DataFrame:
    """The documents with `value` and a `score` from 0 to 1, higher for toxic
    ones, in place of columns of these names. Null texts are empty; every row
    gets a score, and equal texts get the same."""
    valued = add_values(without(docs, ["score"]), model, text)
    return valued.withColumn("score", 1 / (1 + F.exp(-(F.col("value") * model.slope + model.intercept))))
