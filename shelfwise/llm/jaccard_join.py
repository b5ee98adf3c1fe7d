"""Documents whose sets of word shingles are alike, exactly, without comparing all.

Two sets with a Jaccard similarity of 0.8 or more differ in at most a ninth of
their sizes' sum: |x| + |y| >= 9 * |x - y|. So the universe of shingles is cut
by hash into more segments than that, as many as the size band asks for; then
two such sets agree on at least one segment (pigeonhole), and a set's segments
are the keys of an index. A set is indexed under its own band and, if it is
small enough to be the larger partner of a set there, under the band below.

A segment without shingles is no key. A set that has too few others asks for
one-deletion neighbourhoods of some segments (a segment and all it becomes by
losing one shingle also meet segments that differ by one), or, if those do not
suffice, for empty segments as keys after all; all sets of that band then add
these. Keys beyond what the pigeonhole needs are a set's to spare: it spends
them on the fullest buckets (see `_open`).

Every candidate pair is verified once by its whole sets, in the least cluster that
has both or else as a row. In small buckets pairs are rows. Large ones that share
members are put together to clusters, cut into blocks of bounded size; a task takes
two blocks, looks at pairs that share one of their rarest shingles, and returns a
number of links for each set and as many links as connect what is similar. Equal
sets are one set throughout. Shingles and sets are known by 64-bit hashes, sets by
their size as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.frames import chunks, joined, written
from shelfwise.llm.hashing import LOWER, byte_set, mix, words

SHINGLE = 5
#: Ratio of the largest sizes of neighbouring bands.
BAND_RATIO = 1.5
#: Segments beyond the pigeonhole's need, as a share of it.
SPARE = 0.15
#: Keys that a task gathers before it sends them.
HELD_KEYS = 1 << 21
#: Members up to which the pairs of a bucket are rows. Larger buckets are joined
#: to clusters, which are compared block by block of about so many shingles.
BUCKET_LIMIT = 8
BLOCK_SHINGLES = 1 << 20
#: Ids up to which a list of documents to read is broadcast (some 30 bytes each).
BROADCAST_IDS = 1 << 20

U = np.uint64
_blank = byte_set([0x20, *range(0x09, 0x0E)])
_weights = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], U)
_key = np.dtype([("low", "<u4"), ("high", "u1"), ("set", "<i8")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each row of bytes, the sorted hashes of its distinct shingles of five
    words; of the whole sequence if it has fewer words; none without words."""
    hashes, _, first = words(LOWER[data], offsets, ~_blank)
    n = len(hashes)
    runs = np.zeros(max(n - SHINGLE + 1, 0), U)
    for j, weight in enumerate(_weights):
        runs += hashes[j : j + len(runs)] * weight
    runs = mix(runs)
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            found.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            found.append(mix(np.array([(hashes[a:b] * _weights[: b - a]).sum() + U(b - a)], U)))
        else:
            found.append(np.zeros(0, U))
    return found


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * |a and b| >= 80 * |a or b| for sorted sets; empty sets are like nothing."""
    if not len(a) or not len(b) or 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 80 * (len(a) + len(b) - common)


def band_tops(largest: int) -> list[int]:
    """Largest set size of each band, up to the one that holds `largest`."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND_RATIO)))
    return tops


def need(size: int) -> int:
    """Segments on which a set must be looked up to meet all partners that are
    no smaller: more than the most that the two can differ in."""
    return (size + size * 5 // 4) // 9 + 1


def segments(top: int) -> int:
    return int(need(top) * (1 + SPARE)) + 1 if top > 3 else 1


def schemes(sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, bands, own) for sets of these sizes: their own bands, then lower
    ones in which they can be the larger partner. Empty sets have none."""
    tops = np.array(band_tops(int(sizes.max(initial=1))))
    rows = np.flatnonzero(sizes)
    bands = np.searchsorted(tops, sizes[rows])
    found, own = [(rows, bands, True)], bands
    while True:
        own = own - 1
        fits = (own >= 0) & (tops[own] * 5 // 4 >= sizes[rows])
        rows, own = rows[fits], own[fits]
        if not len(rows):
            return found
        found.append((rows, own, False))


class Segmented:
    """Sets cut into the segments of a scheme: for each segment of each set,
    its place in one array of sums of shingle hashes and of counts."""

    def __init__(self, sets: list[np.ndarray], rows: np.ndarray, bands: np.ndarray) -> None:
        tops = np.array(band_tops(max((len(s) for s in sets), default=1)))
        self.m = np.array([segments(int(t)) for t in tops], np.int64)[bands]
        own = [sets[i] for i in rows]
        size = np.array([len(s) for s in own], np.int64)
        self.first = np.cumsum(self.m) - self.m
        self.total = int(self.m.sum())
        shingles = np.concatenate(own) if own else np.zeros(0, U)
        segment = ((shingles >> U(32)) * np.repeat(self.m.astype(U), size)) >> U(32)
        self.at = np.repeat(self.first, size) + segment.astype(np.int64)
        self.parts = mix(shingles + U(0x632BE59BD9B4E019))
        self.sums = np.zeros(self.total, U)
        np.add.at(self.sums, self.at, self.parts)
        self.counts = np.bincount(self.at, minlength=self.total)
        self.set = np.repeat(np.arange(len(rows)), self.m)
        self.index = np.arange(self.total) - self.first[self.set]
        self.band = bands[self.set]

    def keys(self, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A key says band, segment and content."""
        place = self.band[at].astype(U) << U(40) | self.index[at].astype(U)
        return mix(sums + mix(place + U(1)))


def demands(sets: list[np.ndarray], rows: np.ndarray, bands: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """For sets in their own bands: keys to spare, and what they ask for as
    2 * segment (deletions) or 2 * segment + 1 (the empty key)."""
    cut = Segmented(sets, rows, bands)
    spare, asked = [], []
    for i, row in enumerate(rows):
        counts = cut.counts[cut.first[i] : cut.first[i] + cut.m[i]]
        left = int((counts > 0).sum()) - need(len(sets[row]))
        own: list[int] = []
        if left < 0:
            own = [2 * int(s) for s in np.flatnonzero(counts > 1)[:-left]]
            own += [2 * int(s) + 1 for s in np.flatnonzero(counts == 0)[: -left - len(own)]]
            left += len(own)
        spare.append(left)
        asked.append(own)
    return spare, asked


def _set_ids(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([int(mix(s + U(0xD1B54A32D192ED03)).sum()) & (2**64 - 1) for s in sets], U).view(np.int64)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, set, n, band, spare, asked for each document."""
    for batch in chunks(batches, "text"):
        sets = shingle_sets(*joined(batch.column("text")))
        n = np.array([len(s) for s in sets], np.int64)
        rows, bands, _ = schemes(n)[0]
        band, spare = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        asked: list = [[]] * len(n)
        band[rows] = bands
        spare[rows], wishes = demands(sets, rows, bands)
        for i, own in zip(rows.tolist(), wishes, strict=True):
            asked[i] = own
        arrays = [batch.column("doc_id"), pa.array(_set_ids(sets)), pa.array(n), pa.array(band), pa.array(spare)]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(asked, pa.list_(pa.int64()))], names=["doc_id", "set", "n", "band", "spare", "asked"]
        )


def _keyed(asked: dict[int, list[int]], parts: int):
    """Keys of all sets, each set once per task, in blobs by part of the key space.

    A blob holds 13 bytes for each key: 39 bits of it, whether it is of the
    set's own band, and the set.
    """

    def send(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, rows = (np.concatenate(x) for x in zip(*held, strict=True))
        part = ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(edges))
        rows = rows[order]
        blobs = [rows[edges[p] : edges[p + 1]].tobytes() for p in full]
        return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        held, size = [], 0
        for batch in chunks(batches, "text"):
            sets, ids = [], []
            every = shingle_sets(*joined(batch.column("text")))
            for s, i in zip(every, _set_ids(every).tolist(), strict=True):
                if len(s) and i not in known:
                    known.add(i)
                    sets.append(s)
                    ids.append(i)
            ids = np.array(ids, np.int64)
            for rows, bands, own in schemes(np.array([len(s) for s in sets], np.int64)):
                cut = Segmented(sets, rows, bands)
                at = np.flatnonzero(cut.counts)
                found = [(cut.keys(cut.sums[at], at), at)]
                for band in np.intersect1d(bands, list(asked)).tolist():
                    for wish in asked[band]:
                        if wish % 2:
                            at = np.flatnonzero((cut.band == band) & (cut.index == wish // 2) & (cut.counts == 0))
                            found.append((cut.keys(cut.sums[at], at), at))
                        else:
                            one = np.flatnonzero((cut.band[cut.at] == band) & (cut.index[cut.at] == wish // 2))
                            at = cut.at[one]
                            found.append((cut.keys(cut.sums[at] - cut.parts[one], at), at))
                for keys, at in found:
                    packed = np.empty(len(keys), _key)
                    rest = mix(keys)  # the part is taken from the upper half of the key itself
                    packed["low"] = rest & U(0xFFFFFFFF)
                    packed["high"] = (rest >> U(32) & U(0x7F)) << U(1) | U(own)
                    packed["set"] = ids[rows[cut.set[at]]]
                    held.append((keys, packed))
                    size += len(keys)
            if size > HELD_KEYS:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)

    return run


def _met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, set, own for each member of a key with several sets. A part's blobs
    are a hash range of all keys."""
    blobs: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            blobs.setdefault(part, []).append(blob)
    while blobs:
        part, own = blobs.popitem()
        rows = np.frombuffer(b"".join(own), _key)
        key = (rows["high"].astype(np.int64) >> 1) << 32 | rows["low"]
        order = np.lexsort((rows["set"], key))
        key, member, flag = key[order], rows["set"][order], rows["high"][order] & 1
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
        flag = np.maximum.reduceat(flag, np.flatnonzero(fresh)) if len(flag) else flag
        key, member = key[fresh], member[fresh]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        several = np.repeat(size > 1, size)
        bucket = mix(key.astype(U) + mix(np.array([part], U))).view(np.int64)
        several = np.flatnonzero(several)
        for a in range(0, len(several), 200_000):
            at = several[a : a + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[at]), pa.array(member[at]), pa.array(flag[at].astype(bool))], names=["bucket", "set", "own"]
            )


def _sets(ids: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """set, shingles for these sets, read from one document of each."""
    wanted = written(ids.join(classes, "set").select("doc_id").distinct(), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    rows = texts.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi").select("text")

    def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = shingle_sets(*joined(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_set_ids(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["set", "shingles"]
            )

    return written(rows.mapInArrow(sets_of, "set long, shingles binary").dropDuplicates(["set"]), "sets")


def _verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that are similar, by their whole sets."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            like = [similar(np.frombuffer(p, U), np.frombuffer(q, U)) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(like, pa.bool_()))

    ids = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
    sets = _sets(ids, texts, classes)
    x = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _open(members: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with the size of their bucket, and those of them that ask there: in
    their own band, and not in a bucket that they can do without. Each set leaves out
    as many of its fullest buckets as it has keys to spare; a partner meets it in
    another."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("cost"))
    sets = classes.select("set", "n", "spare")
    left = written(members.join(sizes, "bucket").join(sets, "set"), "open")
    order = Window.partitionBy("set").orderBy(F.col("cost").desc(), "bucket")
    asking = left.where("own").withColumn("rank", F.row_number().over(order)).where(F.col("rank") > F.col("spare"))
    return left, written(asking.drop("rank", "own", "spare"), "asking")


def _small(left: DataFrame, asking: DataFrame) -> DataFrame:
    """Pairs (a, b) in buckets up to the limit; a asks and is no larger."""
    x = asking.where(F.col("cost") <= BUCKET_LIMIT).select("bucket", F.col("set").alias("a"), F.col("n").alias("na"))
    y = left.where(F.col("cost") <= BUCKET_LIMIT).select("bucket", F.col("set").alias("b"), F.col("n").alias("nb"))
    pairs = x.join(y, "bucket").where("a <> b and na <= nb and 5 * na >= 4 * nb")
    return pairs.select("a", "b").distinct()


def _prefixes(sets: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The rarest shingles of each set, of two similar sets at least one that is
    the same, in the order of shingles: the set, the place among its shingles;
    where each shingle begins and the last ends; and the sizes of the sets."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, which, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((which, held[which], owner))
    which = which[order]
    place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    rare = (place < (size - -(-4 * size // 5) + 1)[owner]) & (held[which] > 1)
    owner, which, place = owner[rare], which[rare], place[rare]
    order = np.lexsort((owner, which))
    owner, which, place = owner[order], which[order], place[order]
    cuts = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1], [True]])) if len(which) else [0]
    return owner, place, np.asarray(cuts), size


def counted(
    sets: list[np.ndarray], weights: np.ndarray, side: np.ndarray, both: bool, clusters: list[list[int]], cluster: int
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """For each set the summed weights of the sets that are similar to it, one
    from each side (or any two, unless `both`), without pairs that are counted in
    a lesser cluster; and links that connect what is similar.

    Of two similar sets, each has one of the other's shingles among its rarest
    |x| - 0.8 |x| + 1, by any order of all shingles; here the number of sets that
    hold them. Only pairs that share one of these are compared.
    """
    owner, place, cuts, size = _prefixes(sets)
    n = len(sets)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.cumsum(size) - size
    marked = np.zeros(int(flat.max(initial=0)) + 1, bool)
    several = [len(c) > 1 for c in clusters]
    sums = np.zeros(n, np.int64)
    root = np.arange(n)
    links: list[tuple[int, int]] = []
    which = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order = np.argsort(owner, kind="stable")
    own = np.searchsorted(owner[order], np.arange(n + 1))
    for a in np.flatnonzero(~side) if both else range(n):
        near = np.zeros(n, bool)
        for at in order[own[a] : own[a + 1]].tolist():
            end = cuts[which[at] + 1]
            # members of a shingle are in ascending order; without sides, each pair is met at its lesser member
            near[owner[(cuts[which[at]] if both else at + 1) : end]] = True
        if both:
            near &= side
        else:
            near[a] = False
        b = np.flatnonzero(near)
        b = b[(5 * np.minimum(size[b], size[a]) >= 4 * np.maximum(size[b], size[a]))]
        if not len(b):
            continue
        marked[flat[first[a] : first[a] + size[a]]] = True
        length = size[b]
        begin = np.cumsum(length) - length
        inside = marked[flat[np.repeat(first[b] - begin, length) + np.arange(int(length.sum()))]]
        common = np.add.reduceat(inside.astype(np.int64), begin)
        marked[flat[first[a] : first[a] + size[a]]] = False
        b = b[100 * common >= 80 * (size[a] + length - common)]
        if several[a]:
            mine = set(clusters[a])
            b = b[[not several[c] or min(mine.intersection(clusters[c])) == cluster for c in b.tolist()]]
        sums[a] += weights[b].sum()
        sums[b] += weights[a]
        for c in np.unique(root[b]).tolist():
            if c != root[a]:
                links.append((int(a), int(b[root[b] == c][0])))
                root[root == c] = root[a]
    return sums, links


def _clusters(left: DataFrame, asking: DataFrame) -> DataFrame:
    """cluster, set, component, n for the members of buckets above the limit."""
    asked = asking.where(F.col("cost") > BUCKET_LIMIT).select("bucket").distinct()
    met = written(left.join(asked, "bucket", "left_semi").select("bucket", "set", "n"), "large")
    # a bucket's cluster is the least set within two steps of it; all its members go there, some to several clusters
    hubs = met.groupBy("bucket").agg(F.min("set").alias("hub"))
    near = met.join(hubs, "bucket").groupBy("set").agg(F.min("hub").alias("near"))
    clusters = met.join(near, "set").groupBy("bucket").agg(F.min("near").alias("cluster"))
    return written(met.join(clusters, "bucket").select("cluster", "set", "n").distinct(), "clusters")


def _dealt(sets: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Clusters in pairs of blocks: each set with its shingles for each block of
    its cluster, `low` and `high` being that and its own."""
    blocks = sets.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = sets.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    whole = _sets(placed.select("set").distinct(), texts, classes)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.join(whole, "set").withColumn("other", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )


def _all_links(members: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, n): links that connect all similar sets, and in rows with a = b how
    many documents other sets give a set as links, in parts to be summed."""
    left, asking = _open(members, classes)
    weights = classes.select("set", "weight")
    sets = _clusters(left, asking)
    of_set = written(sets.groupBy("set").agg(F.sort_array(F.collect_set("cluster")).alias("clusters")), "of-set")
    pairs = _small(left, asking)
    for side in ("a", "b"):
        pairs = pairs.join(of_set.select(F.col("set").alias(side), F.col("clusters").alias(f"of_{side}")), side, "left")
    # each pair once: a and b if they are alike in size can both ask; with a common cluster it is compared there
    apart = pairs.where(~F.coalesce(F.arrays_overlap("of_a", "of_b"), F.lit(False)))
    apart = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    few = written(_verified(written(apart, "small"), texts, classes), "links-1")
    ends = few.select("a", "b").union(few.select(F.col("b").alias("a"), F.col("a").alias("b")))
    numbers = ends.join(weights, F.col("b") == F.col("set")).groupBy("a").agg(F.sum("weight").alias("n"))

    def compare(rows: pa.Table) -> pa.Table:
        ids = rows.column("set").to_numpy()
        sets = [np.frombuffer(s, U) for s in rows.column("shingles").to_pylist()]
        side = rows.column("block").to_numpy() == rows.column("high").to_numpy()
        cluster = rows.column("cluster")[0].as_py()
        both = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()  # blocks can be empty
        weights, clusters = rows.column("weight").to_numpy(), rows.column("clusters").to_pylist()
        sums, links = counted(sets, weights, side, both, clusters, cluster)
        full = np.flatnonzero(sums)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table(
            {
                "a": pa.array(np.concatenate([ids[full], ids[a]])),
                "b": pa.array(np.concatenate([ids[full], ids[b]])),
                "n": pa.array(np.concatenate([sums[full], np.zeros(len(a), np.int64)])),
            }
        )

    dealt = _dealt(sets, texts, classes).join(of_set, "set").join(weights, "set")
    many = written(dealt.groupBy("cluster", "low", "high").applyInArrow(compare, "a long, b long, n long"), "links-2")
    return many.union(few.select("a", "b", F.lit(0).cast("long"))).union(numbers.select("a", F.col("a").alias("b"), "n"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each document: component_id is
    the least doc_id that can be reached by links, its own if there are none;
    n_links is the number of other documents that it is linked to, an id counting
    once for each set of shingles that it occurs with.

    Null and blank texts have no shingles and no links. Documents without an id
    are returned with component_id null and link to nothing. Repeated rows are
    returned each. Other columns are ignored. An empty table gives no row.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, set long, n long, band long, spare long, asked array<long>"
    known = written(texts.mapInArrow(_described, schema), "sets")
    usable = known.where("n > 0 and doc_id is not null")
    classes = written(
        usable.groupBy("set", "n").agg(F.min("doc_id").alias("doc_id"), F.min("spare").alias("spare"), F.count_distinct("doc_id").alias("weight")), "classes"
    )
    # at most a few wishes for each band and segment, however many sets ask for them
    wishes = usable.select("band", F.explode("asked").alias("wish")).distinct().collect()
    asked: dict[int, list[int]] = {}
    for band, wish in sorted(tuple(w) for w in wishes):
        asked.setdefault(band, []).append(wish)

    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.where("doc_id is not null").select("text").mapInArrow(_keyed(asked, parts), "part int, blob binary")
    members = written(
        keyed.repartition(parts // 4, "part").mapInArrow(_met, "bucket long, set long, own boolean"), "members"
    )
    found = written(_all_links(members, texts, classes), "links")
    labels = components(found.where("a <> b").select("a", "b"))
    numbers = found.groupBy(F.col("a").alias("set")).agg(F.sum("n").alias("others"))
    classes = classes.join(numbers, "set", "left").withColumn("links", F.coalesce("others", F.lit(0)) + F.col("weight") - 1)
    named = classes.join(labels, F.col("set") == F.col("node"), "left").withColumn("label", F.coalesce("label", "set"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    final = written(named.join(least, "label").select("set", "n", "component_id", "links"), "final")
    return known.join(final, ["set", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"),
    )
