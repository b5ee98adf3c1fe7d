"""Stretches of words that repeat with a period, and texts without the repeats.

A run is a stretch that keeps a smallest period and that no neighbouring word
extends. Each run holds a Lyndon word of its period's length that is the longest one
beginning at its place, by one of the two orders of words: it ends where the next
lesser (or greater) suffix begins. So every place gives two candidates, and each is
extended both ways by longest common extensions: to the right from the suffix tree of
the words, to the left from that of the reversal. Ukkonen's construction builds the
trees, the Euler tour of a tree and the minima over it give the depth of the lowest
common ancestor of two leaves in constant time.

A run of at least e periods holds each of its words e times or more. Words that a
stretch holds fewer times are therefore ends of stretches, again and again until
nothing changes, and stretches below the least length hold no run; trees are built of
all others. The trees of many stretches make one forest, which numpy tours at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.frames import chunks, extended, joined, plus
from shelfwise.llm.hashing import byte_set, piece_hashes, run_starts

#: Bytes of words: all but blanks, line ends and tabs of ASCII.
WORD = ~byte_set([9, 10, 11, 12, 13, 32])

_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_COLUMNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(_RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)


def suffix_tree(words: list[int], size: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Ukkonen's tree of numbers below `size` that ends with one found nowhere else.

    For each node: where its edge begins in the words, its parent (the root, 0, has
    -1) and its depth in words (0 for leaves, which reach to the end). And the leaf
    of each suffix.
    """
    n = len(words)
    start, end, link, parent, depth = [0], [0], [0], [-1], [0]
    children: dict[int, int] = {}
    leaves: list[int] = []
    node = edge = length = count = 0
    for i, word in enumerate(words):
        waiting = 0  # the inner node made last, which lacks its link
        while count <= i:
            if not length:
                edge = i
            key = node * size + words[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(start)
                above = node
            else:
                span = end[child] - start[child]
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                at = start[child] + length
                if words[at] == word:
                    if waiting:
                        link[waiting] = node
                    length += 1
                    break
                above = len(start)
                start.append(start[child])
                end.append(at)
                link.append(0)
                parent.append(node)
                depth.append(depth[node] + length)
                children[key] = above
                start[child], parent[child] = at, above
                children[above * size + words[at]] = child
                children[above * size + word] = len(start)
            if waiting:
                link[waiting] = above
            waiting = above if child is not None else 0
            leaves.append(len(start))
            start.append(i)
            end.append(n)
            link.append(0)
            parent.append(above)
            depth.append(0)
            count += 1
            if node:
                node = link[node]
            elif length:
                length, edge = length - 1, count
    return start, parent, depth, leaves


def forest(stretches: list[list[int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parent, order among siblings and depth of the nodes of all trees, a further
    root above theirs at the end, and the leaf of each suffix, tree by tree. Each
    stretch ends with a 0, which comes before all words."""
    parents, orders, depths, leaves = [], [], [], []
    roots, total = [], 0
    for number, words in enumerate(stretches):
        start, parent, depth, leaf = suffix_tree(words, size)
        order = np.array(words, np.int64)[start]
        order[0] = number
        parent, depth, leaf = np.array(parent, np.int64), np.array(depth, np.int64), np.array(leaf, np.int64)
        depth[leaf] = np.arange(len(leaf), 0, -1)
        parents.append(parent + total)
        orders.append(order)
        depths.append(depth)
        leaves.append(leaf + total)
        roots.append(total)
        total += len(start)
    parent = np.concatenate([*parents, [total]])
    parent[roots] = total
    return parent, np.concatenate([*orders, [0]]), np.concatenate([*depths, [0]]), np.concatenate(leaves)


def euler_tour(parent: np.ndarray, order: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each node is met first, and the depths along the tour. The root comes
    last and is its own parent. Sums over subtrees and along paths double their
    reach step by step, so high trees take few passes."""
    root = len(parent) - 1
    size = np.ones(root + 1, np.int64)
    jump = parent.copy()
    while (jump[:root] < root).any():
        size[:root] += np.bincount(jump, weights=size, minlength=root + 1)[:root].astype(np.int64)
        jump = jump[jump]
    row = np.lexsort((order[:root], parent[:root]))
    steps = 2 * size[row]
    before = np.cumsum(steps) - steps
    fresh = np.concatenate([[True], parent[row][1:] != parent[row][:-1]])
    first = np.zeros(root + 1, np.int64)
    first[row] = before - before[fresh][np.cumsum(fresh) - 1] + 1
    jump = parent.copy()
    while (jump[:root] < root).any():
        first += first[jump]
        jump = jump[jump]
    tour = np.zeros(2 * root + 1, np.int32)
    tour[first] = depth
    tour[first[:root] + 2 * size[:root] - 1] = depth[parent[:root]]
    return first, tour


class Extensions:
    """Longest common prefixes of suffixes of a forest's stretches."""

    def __init__(self, stretches: list[list[int]], size: int) -> None:
        parent, order, depth, leaves = forest(stretches, size)
        first, tour = euler_tour(parent, order, depth)
        place = first[leaves]
        by_place = np.argsort(place)
        #: The place of each suffix in the order of all suffixes, stretch by stretch.
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[by_place] = np.arange(len(leaves))
        # the least depth on the way from a leaf to the next one
        least = np.minimum.reduceat(tour, place[by_place])
        rows = [least]
        while 1 << len(rows) <= len(least):
            half = 1 << len(rows) - 1
            wide = rows[-1].copy()
            wide[:-half] = np.minimum(rows[-1][:-half], rows[-1][half:])
            rows.append(wide)
        self.least = np.stack(rows)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For suffixes numbered over all stretches, each with its 0; a and b differ."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        row = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.least[row, low], self.least[row, high - (np.int64(1) << row)]).astype(np.int64)


def _next(rank: list[int]) -> tuple[list[int], list[int]]:
    """Where the next lesser and the next greater number stands, or the end."""
    n = len(rank)
    lesser, greater = [n] * n, [n] * n
    low, high = [], []
    for i, r in enumerate(rank):
        while low and rank[low[-1]] > r:
            lesser[low.pop()] = i
        while high and rank[high[-1]] < r:
            greater[high.pop()] = i
        low.append(i)
        high.append(i)
    return lesser, greater


def find_runs(stretches: list[np.ndarray], size: int, least_length: int, least_exponent: int) -> np.ndarray:
    """Rows of (stretch, start, length, period) for all runs of that length and so
    many periods, at least 2. Words are numbers from 1 to size - 1."""
    lengths = np.array([len(s) for s in stretches], np.int64)
    if not lengths.sum():
        return np.zeros((0, 4), np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1  # each stretch has one more place, for its 0
    right = Extensions([[*s.tolist(), 0] for s in stretches], size)
    lesser, greater = _next(right.rank.tolist())
    total = int(lengths.sum() + len(lengths))
    stretch = np.repeat(np.arange(len(lengths)), lengths + 1)
    a = np.concatenate([np.arange(total)] * 2)
    b = np.concatenate([np.array(lesser), np.array(greater)])
    inside = b < total
    a, b = a[inside], b[inside]
    inside = stretch[a] == stretch[b]
    a, b = a[inside], b[inside]
    period = b - a
    after = right.common(a, b)
    # the leftmost such word of a run begins within its first period
    wide = after > (least_exponent - 2) * period
    a, b, period, after = a[wide], b[wide], period[wide], after[wide]
    if not len(a):
        return np.zeros((0, 4), np.int64)
    del right
    left = Extensions([[*s[::-1].tolist(), 0] for s in stretches], size)
    at = stretch[a]
    mirrored = 2 * begin[at] + lengths[at]  # the place before x is this less x in the reversal
    before = np.where(a > begin[at], left.common(mirrored - a, mirrored - b), 0)
    length = before + period + after
    found = np.stack([at, a - before - begin[at], length, period], 1)
    return np.unique(found[(length >= least_length) & (length >= least_exponent * period)], axis=0)


def _stretches(word: np.ndarray, row: np.ndarray, least_length: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretches that can hold runs begin and end among the words, which are
    numbers from 0."""
    at = np.arange(len(word))  # words that are left
    group = row  # of each of them
    size = int(word.max(initial=0)) + 1
    while len(at):
        _, which, count = np.unique(group * size + word[at], return_inverse=True, return_counts=True)
        kept = count[which] >= least_exponent
        if kept.all():
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            long = np.diff(np.append(first, len(at))) >= least_length
            if long.all():
                return at[first], at[np.append(first[1:], len(at)) - 1] + 1
            kept = np.repeat(long, np.diff(np.append(first, len(at))))
        last, old = at[kept], group[kept]
        fresh = np.ones(len(last), bool)
        fresh[1:] = (np.diff(last) > 1) | (np.diff(old) != 0)
        at, group = last, np.cumsum(fresh)
    return at, at


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word its hash, where it begins and ends, and its row."""
    inside = WORD[data]
    start = run_starts(inside, offsets[:-1])
    begin = np.flatnonzero(start)
    # a word ends where the next byte belongs to none, begins a word, or another row
    last = inside.copy()
    last[:-1] &= ~inside[1:] | start[1:]
    return piece_hashes(data, inside, start), begin, np.flatnonzero(last) + 1, np.searchsorted(offsets, begin, "right") - 1


def _rejoined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int) -> list[bytes]:
    """The words of each row, joined by one blank."""
    size = end - begin + 1
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    take = np.repeat(begin - (stop - size), size) + np.arange(total)
    blank = stop - 1
    take[blank] = 0
    text = data[take] if total else np.zeros(0, np.uint8)
    text[blank] = 32
    whole = text.tobytes()
    cuts = np.append(0, stop)[np.searchsorted(row, np.arange(rows + 1))].tolist()
    return [whole[a : max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def collapse(docs: DataFrame, text: str = "text", least_length: int = 24, least_exponent: int = 3) -> DataFrame:
    """Adds n_words, runs and collapsed to each row, one row out for each row in.

    runs holds start (number of the first word, from 0), length and period of every
    run of at least `least_length` words and `least_exponent` (2 or more) periods, by
    start and period. collapsed is the text's words joined by one blank, without
    those that come after the first period of a run that contains them.

    Null and blank texts have no words, no runs and an empty text. Columns of the
    input that clash with the added ones are replaced. Words are known by 64-bit
    hashes, see `hashing`. Texts are looked at whole; a task needs about a kilobyte
    for each word in stretches that can hold runs of its longest text.
    """
    if least_exponent < 2:
        raise ValueError("a run has two periods at least")
    own = docs
    if text.lower() in {name.lower() for name in _COLUMNS.names}:
        own, text = docs.withColumn("_text_of_runs", F.col(f"`{text}`")), "_text_of_runs"
    kept, schema = extended(own, _COLUMNS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            data, offsets = joined(batch.column(text))
            hashes, begin, end, row = _words(data, offsets)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            distinct, number = np.unique(hashes, return_inverse=True)
            low, high = _stretches(number, row, least_length, least_exponent)
            stretches = [number[a:b] + 1 for a, b in zip(low, high, strict=True)]
            runs = find_runs(stretches, len(distinct) + 1, least_length, least_exponent)
            start = low[runs[:, 0]] + runs[:, 1] if len(runs) else np.zeros(0, np.int64)
            length, period = runs[:, 2], runs[:, 3]
            order = np.lexsort((period, start))
            start, length, period = start[order], length[order], period[order]
            depth = np.zeros(len(begin) + 1, np.int64)  # runs that drop a word
            np.add.at(depth, start + period, 1)
            np.add.at(depth, start + length, -1)
            left = np.cumsum(depth[:-1]) == 0
            owner = row[start]
            values = [pa.array(v) for v in (start - first[owner], length, period)]
            yield plus(
                batch,
                {
                    "n_words": pa.array(np.diff(first)),
                    "runs": pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32()),
                        pa.StructArray.from_arrays(values, names=_RUN.names),
                    ),
                    "collapsed": pa.array(
                        _rejoined(data, begin[left], end[left], row[left], batch.num_rows), pa.binary()
                    ).cast(pa.string()),
                },
            )

    return kept.mapInArrow(run, schema).drop("_text_of_runs")


def most_periods(runs: Column) -> Column:
    """The run with the greatest length by its period, the first of equal ones; null
    without runs. Compared by products, so exactly."""
    none = F.lit(None).cast(_RUN.simpleString())
    more = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    return F.aggregate(runs, none, lambda a, b: F.when(more(a, b), b).otherwise(a))
