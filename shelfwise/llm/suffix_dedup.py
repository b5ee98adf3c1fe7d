"""Strings of at least `length` bytes that occur more than once, and texts without them.

Every byte is marked that a string of `length` bytes covers which also starts
anywhere else, in the same text or another one; texts are UTF-8 bytes, and no
string reaches over a text's end.

1. Of each window of `length` bytes, the ANCHOR bytes with the least hash are
   its anchor. Equal windows have equal anchors in equal places, so only texts
   that share an anchor can share a window, and only around it. Anchors take
   about two places in 138 bytes; they are grouped by hash.
2. Members of a group whose whole surroundings are equal are one member; what
   they cover occurs twice. Surroundings that occur with others in a group are
   fetched. A passage that many texts share makes large groups, in which it is
   equal and what is around it differs; these are halved by longer common strings
   and shorter surroundings, members that have become equal are one again, until
   what is left is small.
3. Small groups are concatenated to a text of bounded size each, whose
   Burrows-Wheeler transform gives the lengths of common prefixes of
   neighbouring suffixes by increasing value: intervals of suffixes are
   extended backward breadth-first, one byte a round, and each interval's
   border that no shorter string has set gets the length of the round. Rounds
   stop at `length`; suffixes without a border between them share that much.

Texts are known by 64-bit hashes and taken once each, however often they occur.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.frames import chunks, texts, written
from shelfwise.llm.hashing import BYTES, mix

LENGTH = 200
ANCHOR = 64
#: Members of a group that are transformed; larger groups are halved.
SMALL_GROUP = 2
#: Members of a group that a task halves by itself; larger ones are halved by Spark.
GROUP_LIMIT = 1 << 15
#: Bytes of the texts that are transformed at once; this size stays in a core's cache.
TRANSFORM_BYTES = 1 << 17
#: Texts to fetch up to which their ids are broadcast (some 30 bytes each).
BROADCAST_IDS = 1 << 20

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = (np.ones(1, U), np.ones(1, U))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, U)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=U))
        _powers = tuple(tables)
    return _powers


def _sliding(values: np.ndarray, width: int, fold: np.ufunc, fill: int) -> np.ndarray:
    """The least (or greatest) of each `width` neighbouring values."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    block = np.full(rows * width, fill, values.dtype)
    block[: len(values)] = values
    block = block.reshape(rows, width)
    ahead = fold.accumulate(block, axis=1).ravel()
    back = fold.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors, their hashes, and hashes of their surroundings (with
    how far these reach to either side); none in a text shorter than `length`."""
    n = len(text)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(BYTES[np.frombuffer(text, np.uint8)] * up[:n], out=sums[1:])
    grams = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: n - ANCHOR + 1])
    width = length - ANCHOR + 1
    least = _sliding(grams, width, np.minimum, 2**64 - 1)
    # a place is an anchor if it is the least of one of the windows it is in
    padded = np.concatenate([np.zeros(width - 1, U), least, np.zeros(width - 1, U)])
    at = np.flatnonzero(_sliding(padded, width, np.maximum, 0) == grams)
    start, end = np.maximum(at - (length - ANCHOR), 0), np.minimum(at + length, n)
    around = mix((sums[end] - sums[start]) * down[start])
    around = mix(around + mix(((at - start) << 20 | (end - start)).astype(U)))
    return at, grams[at], around


def _anchored(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in chunks(batches, "text"):
            rows = []
            for i, text in zip(batch.column("id").to_pylist(), texts(batch.column("text")), strict=True):
                if i not in known:
                    known.add(i)
                    at, grams, around = anchors(text, length)
                    rows.append((grams, around, np.full(len(at), i, np.int64), at))
            if rows:
                gram, around, ids, at = (np.concatenate(c) for c in zip(*rows, strict=True))
                arrays = [pa.array(gram.view(np.int64)), pa.array(around.view(np.int64)), pa.array(ids), pa.array(at.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "around", "id", "pos"])

    return run


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of gram, around, id, pos: members whose surroundings
    are repeated (twice true), and for groups with several surroundings the
    first member of each (twice false). Keeps one row of the last batch and the
    first member of a group, so groups may be of any size."""
    names = ["gram", "around", "id", "pos"]
    before: list[int] | None = None  # the last row
    alike = False  # whether it equals the row before it
    first: list[int] | None = None  # first member of its group, if not sent yet

    def out(twice: bool, rows: list[np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(rows[0]), pa.array(rows[2]), pa.array(rows[3].astype(np.int32))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(rows[0]), twice))], names=["gram", "id", "pos", "twice"])

    for batch in batches:
        rows = [batch.column(c).to_numpy().astype(np.int64) for c in names]
        if before is not None:
            rows = [np.concatenate([[b], r]) for b, r in zip(before, rows, strict=True)]
        same = np.logical_and.reduce([r[1:] == r[:-1] for r in rows])
        kept = np.concatenate([[True], ~same])  # the same place from two tasks
        rows = [r[kept] for r in rows]
        n = len(rows[0])
        if not n:
            continue
        old = before is not None  # row 0 was seen in the last batch
        new_group = np.ones(n, bool)
        new_group[1:] = rows[0][1:] != rows[0][:-1]
        new_class = new_group.copy()
        new_class[1:] |= rows[1][1:] != rows[1][:-1]
        like_before = ~new_class
        like_before[0] = alike if old else False
        like_after = np.zeros(n, bool)
        like_after[:-1] = ~new_class[1:]
        covered = (like_before | like_after)[: n - 1]  # the last row's turn comes with the next batch
        if covered.any():
            yield out(True, [r[: n - 1][covered] for r in rows])
        later = new_class & ~new_group  # a further class of a group
        if later.any():
            sent = [r[later] for r in rows]
            starts = np.flatnonzero(new_group)
            groups = np.unique(np.searchsorted(starts, np.flatnonzero(later), "right") - 1)
            leaders = starts[groups]
            if old and leaders[0] == 0:  # its first member may be of an earlier batch, or sent
                leaders = leaders[1:]
                if first is not None:
                    sent = [np.append(s, f) for s, f in zip(sent, first, strict=True)]
                first = None
            yield out(False, [np.concatenate([s, r[leaders]]) for s, r in zip(sent, rows, strict=True)])
        last = int(np.flatnonzero(new_group)[-1])
        if last > 0 or not old:
            first = None if later[last:].any() else [int(r[last]) for r in rows]
        before, alike = [int(r[-1]) for r in rows], bool(like_before[-1])
    if before is not None and alike:
        yield out(True, [np.array([b]) for b in before])


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of an array of 16-bit numbers that ends in its only zero."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(6, symbols.dtype)]).astype(U)
    key = np.zeros(n, U)
    for i in range(7):  # numbers below 512
        key = key << U(9) | padded[i : n + i]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    place = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))  # a class is named by its first place
    rank = np.empty(n, np.int64)
    rank[order] = place
    step = 7
    while True:
        single = fresh & np.append(fresh[1:], True)
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            return order
        own = order[open_at]
        following = rank[np.minimum(own + step, n - 1)]
        again = np.argsort(rank[own] << 32 | following, kind="stable")
        own, following = own[again], following[again]
        order[open_at] = own
        head = rank[own]
        new = np.concatenate([[True], (head[1:] != head[:-1]) | (following[1:] != following[:-1])])
        fresh[open_at] = new
        rank[own] = np.maximum.accumulate(np.where(new, open_at, 0))
        step *= 2


def long_borders(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in the order shares fewer than `length` symbols with
    the one before it, by backward extension on the transform. Strings with a
    symbol below 2 are not extended: where such a symbol comes within the
    length, the answer says nothing."""
    n = len(symbols)
    transform = symbols[order - 1]  # the symbol before each suffix
    by_symbol = np.argsort(transform, kind="stable")
    step = np.empty(n, np.int64)  # where the suffix that begins one earlier stands
    step[by_symbol] = np.arange(n)
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        usable = transform[at] > 1
        at, owner = at[usable], owner[usable]
        to = step[at]
        if len(at) > n // 4:  # the places of one symbol in one interval go to neighbouring places
            held = np.full(n, -1)
            held[to] = owner
            to = np.flatnonzero(held >= 0)
            owner = held[to]
        else:
            sort = np.argsort(to)
            to, owner = to[sort], owner[sort]
        if not len(to):
            break
        symbol = symbols[order[to]]
        change = np.flatnonzero((owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])) + 1
        low, high = to[np.append(0, change)], to[np.append(change, len(to)) - 1] + 1
        new = ~border[high]
        border[high] = True
        low, high = low[new], high[new]
        if not len(low):
            break
    return border[:n]


def repeated_windows(parts: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts and places in them where strings of `length` bytes begin that also
    begin elsewhere: another text (`ids`) or another place of it (`starts` says
    where a part begins in its text)."""
    sizes = np.array([len(p) + 1 for p in parts])
    symbols = np.frombuffer(b"\0".join(parts) + b"\0\0", np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes) - 1
    symbols[ends], symbols[-1] = 1, 0
    order = suffix_array(symbols)
    group = np.cumsum(long_borders(symbols, order, length))
    part = np.repeat(np.arange(len(parts)), sizes)
    place = np.arange(len(part)) - (ends - sizes + 1)[part]
    order, group = order[1:], group[1:]  # without the end mark
    whole = place[order] + length < sizes[part[order]]
    order, group = order[whole], group[whole]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner, at = ids[part[order]], starts[part[order]] + place[order]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    differ = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
    differ |= np.minimum.reduceat(at, first) != np.maximum.reduceat(at, first)
    hit = order[np.repeat(differ, np.diff(np.append(first, len(order))))]
    return part[hit], place[hit]


Member = tuple[int, int, int, bytes]  # id, place of the anchor in its text, in its surroundings, these


def halved(members: list[Member], low: int, high: int, length: int) -> tuple[list[tuple[int, int, int]], list[list[Member]]]:
    """For members around equal anchors: spans (id, start, end) of repeated
    windows that begin `low` to `high` bytes before the anchor and were found
    equal as a whole, and small groups in which repeated windows may be left.
    All windows of a member hold its anchor, so together they are one span.
    """
    found: dict[tuple[int, int], tuple[int, int]] = {}
    small, queue = [], [(members, low, high)]
    while queue:
        members, low, high = queue.pop()
        by_core: dict[bytes, list[Member]] = {}
        for m in members:  # the string that all these windows hold
            reach, text = m[2], m[3]
            if reach >= low and len(text) - reach >= length - high:
                by_core.setdefault(text[reach - low : reach + length - high], []).append(m)
        for own in by_core.values():
            if len(own) < 2:
                continue
            by_text: dict[tuple[int, bytes], list[Member]] = {}
            for i, pos, reach, text in own:  # all that these windows can hold
                left = min(reach, high)
                part = text[reach - left : reach + length - low]
                by_text.setdefault((left, part), []).append((i, pos, left, part))
            for (left, part), equal in by_text.items():
                if len(equal) > 1 and len(part) >= length:
                    for i, pos, _, _ in equal:
                        start, end = found.get((i, pos), (pos, pos))
                        found[i, pos] = min(start, pos - left), max(end, pos - left + len(part))
            rest = [equal[0] for equal in by_text.values()]
            if len(rest) < 2:
                continue
            if len(rest) <= SMALL_GROUP:
                small.append(rest)
            else:
                middle = (low + high) // 2
                queue += [(rest, low, middle), (rest, middle + 1, high)]
    return [(i, start, end) for (i, _), (start, end) in found.items()], small


def _transformed(length: int):
    """id, start, end of what repeated windows cover, from rows in order of key."""

    def out(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
        columns = zip(*spans, strict=True) if spans else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "start", "end"])

    def solve(members: list[Member]) -> pa.RecordBatch:
        members = list(dict.fromkeys(members))  # the same place from two groups
        starts = np.array([pos - reach for _, pos, reach, _ in members], np.int64)
        ids = np.array([m[0] for m in members], np.int64)
        part, place = repeated_windows([m[3] for m in members], ids, starts, length)
        order = np.lexsort((place, part))
        part, place = part[order], place[order]
        # windows that overlap or touch become one span
        fresh = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (place[1:] > place[:-1] + length)])) if len(part) else part
        last = np.append(fresh[1:], len(part)) - 1
        begin = starts[part[fresh]] + place[fresh]
        end = starts[part[last]] + place[last] + length if len(part) else begin
        return out(list(zip(ids[part[fresh]].tolist(), begin.tolist(), end.tolist(), strict=True)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Member] = []
        group: dict[tuple[int, int], Member] = {}  # one for each place, also if two tasks sent it
        size, last = 0, None

        def end_group() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if group:
                spans, small = halved(list(group.values()), last[1], last[2], length)
                group.clear()
                for own in small:
                    held.extend(own)
                    size += sum(len(m[3]) + 1 for m in own)
                if spans:
                    yield out(spans)
            if size > TRANSFORM_BYTES:
                yield solve(held)
                held.clear()
                size = 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "low", "high", "id", "pos", "reach", "text")]
            for key, low, high, i, pos, reach, text in zip(*columns, strict=True):
                if (key, low, high) != last:
                    yield from end_group()
                    last = (key, low, high)
                group[i, pos] = (i, pos, reach, text)
        yield from end_group()
        if held:
            yield solve(held)

    return run


def _surroundings(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "pos", "reach", "text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for i, text, places in zip(batch.column("id").to_pylist(), texts(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                for a in range(0, len(places), 2000):
                    rows = []
                    for p in places[a : a + 2000]:
                        start = max(0, p["pos"] - (length - ANCHOR))
                        rows.append((p["gram"], i, p["pos"], p["pos"] - start, text[start : p["pos"] + length]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def _split(rows: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Groups that a task can hold, and spans (id, start, end) of those whose
    members turned out equal over the whole length.

    A window around an anchor begins between 0 and `length` - ANCHOR bytes
    before it; for half of these beginnings all windows hold a longer string
    around the anchor. A group above the limit becomes the groups of members
    with equal longer strings, for each half, and so on.
    """
    rows = rows.withColumns({"low": F.lit(0), "high": F.lit(length - ANCHOR)})
    small, spans = [], []
    while True:
        rows = written(rows, "groups")
        sizes = rows.groupBy("key", "low", "high").agg(F.count("*").alias("n")).where("n > 1")
        sizes = written(sizes, "sizes")
        if not sizes.where(F.col("n") > GROUP_LIMIT).take(1):
            small.append(rows.join(sizes, ["key", "low", "high"], "left_semi").select(*rows.columns) if small else rows)
            break
        joined = rows.join(sizes, ["key", "low", "high"])
        small.append(joined.where(F.col("n") <= GROUP_LIMIT).drop("n").select(*rows.columns))
        large = joined.where(F.col("n") > GROUP_LIMIT).drop("n")
        done = large.where("low = high").select("id", (F.col("pos") - F.col("low")).alias("start"))
        spans.append(written(done.withColumn("end", F.col("start") + length), "equal"))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high").alias("high")))
        parts = large.where("low < high").withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.low"), "high": F.col("half.high")}).drop("half")
        # the string that all windows of this half hold, if the text reaches so far
        core = F.expr(f"substring(text, cast(reach - low + 1 as int), cast(low + {length} - high as int))")
        parts = parts.where(f"reach >= low and octet_length(text) >= reach + {length} - high")
        rows = parts.withColumn("key", F.xxhash64("key", "low", "high", core)).select(*rows.columns)
    united = small[0]
    for more in small[1:]:
        united = united.unionByName(more)
    return united, spans


def text_ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(value).alias("id"), value.alias("text"))


def _fetched(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (id, ...) with its text, read from one document of each id."""
    ids = wanted.select("id").distinct()
    one = rows.select("doc_id", "id").join(ids, "id", "left_semi").groupBy("id").agg(F.min("doc_id").alias("doc_id"))
    one = written(one, "to-read")
    few = one.count() <= BROADCAST_IDS
    same = rows.withColumnRenamed("id", "_id").withColumnRenamed("doc_id", "_doc_id")
    match = (F.col("_id") == F.col("id")) & F.col("_doc_id").eqNullSafe(F.col("doc_id"))
    read = same.join(F.broadcast(one) if few else one, match, "inner").select("id", "text")
    return read.join(wanted, "id")


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, spans for each distinct text (id: its hash) with any byte to remove
    because of strings that are repeated within distinct texts; spans are sorted
    structs start, end in bytes, which may overlap and end after the text. Texts that occur as a
    whole more than once are not reported for that reason."""
    rows = text_ids(docs, key, text)
    long_enough = rows.where(F.octet_length("text") >= length)
    placed = long_enough.select("id", "text").mapInArrow(_anchored(length), "gram long, around long, id long, pos int")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartition(parts, "gram").sortWithinPartitions("gram", "around", "id", "pos")
    found = written(ordered.mapInArrow(_grouped, "gram long, id long, pos int, twice boolean"), "anchors")

    covered = found.where("twice").select(
        "id", F.greatest(F.col("pos") - (length - ANCHOR), F.lit(0)).cast("long").alias("start"), (F.col("pos") + length).cast("long").alias("end")
    )
    places = found.where("not twice").groupBy("id").agg(F.collect_set(F.struct("gram", "pos")).alias("places"))
    around = _fetched(long_enough, places).mapInArrow(_surroundings(length), "key long, id long, pos long, reach long, text binary")
    groups, spans = _split(around, length)
    ready = groups.repartition(parts, "key").sortWithinPartitions("key", "low", "high", "id", "pos")
    spans.append(written(ready.mapInArrow(_transformed(length), "id long, start long, end long"), "windows"))
    for more in spans:
        covered = covered.unionByName(more)

    return covered.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, spans (merged, within the text), kept: the bytes outside of them."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in chunks(batches, "text"):
        spans, kept = [], []
        for text, own in zip(texts(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            merged: list[dict] = []
            for s in own:
                end = min(s["end"], len(text))
                if merged and s["start"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], end)
                else:
                    merged.append({"start": s["start"], "end": end})
            spans.append(merged)
            edges = [0, *[e for s in merged for e in (s["start"], s["end"])], len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, span), pa.array(kept, pa.binary())], names=["id", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, texts): for each document doc_id, id, n_bytes, whole (its text
    has `length` bytes and occurs more than once, so all of it goes) and the
    SHA-256 of its text; for each distinct text with something to remove id,
    spans and the bytes that are kept, as `kept` (which need not be valid UTF-8).

    Null texts are empty; texts shorter than `length` lose nothing; repeated
    rows are occurrences of their own. Other columns are ignored. Empty tables
    give empty results.
    """
    rows = text_ids(docs, key, text)
    spans = written(repeated_spans(docs, length, key, text), "spans")
    kept = _fetched(rows, spans).select("id", "text", "spans").mapInArrow(
        _cut, "id long, spans array<struct<start:long,end:long>>, kept binary"
    ).dropDuplicates(["id"])
    plain = rows.select("doc_id", "id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))
    often = plain.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    documents = plain.join(often, "id", "left").withColumn("whole", F.col("n").isNotNull() & (F.col("n_bytes") >= length)).drop("n")
    return documents, kept
