"""Hierarchical packing of token sequences into windows of several lengths.

Documents are cut into whole windows of the longest tier while they last; what
remains is routed to the shortest tier that holds it. Each tier then opens a
window for each of its remainders, longest first, and fills the gap from shorter
tiers: the longest remainder that fits, again and again, and at last a piece cut
off the shortest one at hand. When nothing is left to cut, the last windows are
split at powers of two, so that they need no padding. Windows of a tier are
dealt to groups of training steps in turns by their attention cost.

A task packs what it reads, pool by pool of bounded size: nothing is shuffled,
and padding does not grow with the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.encoding import BATCH_BYTES, encoder
from shelfwise.llm.frames import chunks, texts

TIERS = (2048, 1024, 512, 256)
#: Ids that a task holds before it packs them.
POOL_IDS = 1 << 21
#: Windows of one training step group.
GROUP = 8

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, window int, step_group long"
)
_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length")]
    + [("ids", pa.binary())]
    + [(n, pa.int64()) for n in ("doc_tokens", "sequence_id", "offset")]
    + [("window", pa.int32()), ("step_group", pa.int64())]
)


class Lengths:
    """Remainders by length; finds the longest up to a limit with one bit scan."""

    def __init__(self) -> None:
        self.lists: dict[int, list] = {}
        self.bits = 0

    def add(self, length: int, item) -> None:
        if length not in self.lists:
            self.lists[length] = []
        self.lists[length].append(item)
        self.bits |= 1 << length

    def take(self, length: int):
        items = self.lists[length]
        item = items.pop()
        if not items:
            del self.lists[length]
            self.bits &= ~(1 << length)
        return item

    def longest(self, limit: int) -> int:
        """Length of the longest up to `limit`; 0 if there is none."""
        return max(0, (self.bits & ((1 << (limit + 1)) - 1)).bit_length() - 1)

    def shortest(self) -> int:
        return (self.bits & -self.bits).bit_length() - 1 if self.bits else 0


def pack_pool(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows for documents of these lengths: (window length, pieces), a piece
    being (document's place in the list, start, length). Each id lies in one
    piece, and every window is full."""
    top, windows, rest = tiers[0], [], Lengths()
    for i, n in enumerate(lengths):
        whole = n // top * top
        windows += [(top, [(i, start, top)]) for start in range(0, whole, top)]
        if n > whole:
            rest.add(n - whole, (i, whole))
    for tier, below in zip(tiers, (*tiers[1:], 0), strict=True):
        while (size := rest.longest(tier)) > below:
            pieces, used = [(*rest.take(size), size)], size
            while used < tier and rest.bits:
                gap = tier - used
                if size := rest.longest(gap):
                    pieces.append((*rest.take(size), size))
                    used += size
                else:
                    size = rest.shortest()
                    i, start = rest.take(size)
                    pieces.append((i, start, gap))
                    rest.add(size - gap, (i, start + gap))
                    used = tier
            windows += [(tier, pieces)] if used == tier else _split(pieces, used)
    return windows


def _split(pieces: list[tuple[int, int, int]], used: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Pieces of `used` ids in all, cut into windows of powers of two."""
    found, queue = [], list(reversed(pieces))
    while used:
        window, room, own = 1 << (used.bit_length() - 1), 1 << (used.bit_length() - 1), []
        while room:
            i, start, length = queue.pop()
            own.append((i, start, min(length, room)))
            if length > room:
                queue.append((i, start + room, length - room))
            room -= own[-1][2]
        found.append((window, own))
        used -= window
    return found


def step_groups(windows: list, group: int = GROUP) -> list[int]:
    """A group for each window: windows of one length only, dealt to and fro in
    order of attention cost, so that groups of a tier cost about the same."""
    by_window: dict[int, list[tuple[int, int]]] = {}
    for at, (window, pieces) in enumerate(windows):
        by_window.setdefault(window, []).append((sum(p[2] ** 2 for p in pieces), at))
    found, first = [0] * len(windows), 0
    for window in sorted(by_window, reverse=True):
        ordered = sorted(by_window[window], reverse=True)
        n = -(-len(ordered) // group)
        for rank, (_, at) in enumerate(ordered):
            turn, place = divmod(rank, n)
            found[at] = first + (place if turn % 2 == 0 else n - 1 - place)
        first += n
    return found


def _packed(tokenizer_path: str, end_id: int, tiers: tuple[int, ...], pool_ids: int, group: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], encode.dtype)
        sequence = step = TaskContext.get().partitionId() << 40
        keys: list = []
        pool: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, step
            windows = pack_pool([len(ids) for ids in pool], tiers)
            groups = step_groups(windows, group)
            rows = []
            for (window, pieces), own in zip(windows, groups, strict=True):
                offset = 0
                for i, start, length in pieces:
                    ids = pool[i][start : start + length].astype("<u4").tobytes()
                    rows.append((keys[i], start, length, ids, len(pool[i]), sequence, offset, window, step + own))
                    offset += length
                sequence += 1
            step += max(groups, default=-1) + 1
            for i in range(0, len(rows), 2000):
                columns = zip(*rows[i : i + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)
            keys.clear()
            pool.clear()

        held = 0
        for batch in chunks(batches, "text", BATCH_BYTES):
            for key, ids in zip(batch.column("doc_id").to_pylist(), encode.encode(texts(batch.column("text"))), strict=True):
                keys.append(key)
                pool.append(np.concatenate([ids, end]))
                held += len(pool[-1])
                if held >= pool_ids:
                    yield from flush()
                    held = 0
        yield from flush()

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    tiers: tuple[int, ...] = TIERS,
    pool_ids: int = POOL_IDS,
    group: int = GROUP,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, its ids (little-endian unsigned
    32-bit integers), doc_tokens, sequence_id, offset, window, step_group.

    Tiers are powers of two, longest first. A null text is empty and packs its
    end id alone; a null key stays null; repeated rows are packed each; other
    columns are ignored; an empty table gives no piece. A document longer than
    a pool is packed as a pool of its own. Numbers of sequences are unique, not
    gapless: a task takes 2^40 of them. Rows must come in the same order when a
    task is repeated, as they do from a file scan.
    """
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two, longest first")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_packed(tokenizer_path, end_id, tuple(tiers), pool_ids, group), PIECES)
