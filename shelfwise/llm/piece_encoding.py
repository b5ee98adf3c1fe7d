"""Token ids of a SentencePiece BPE model by a table over prefixes, and their texts.

The library merges the best pair of neighbouring pieces again and again. Two facts
about such merges replace that here. What a text's leading pieces cover is encoded
as these pieces, so each prefix has one last piece; and a sequence of pieces is the
encoding of its text if each two neighbours are, alone. So an automaton over the
vocabulary gives the pieces that end at a place, and the one that is compatible with
the last piece of the prefix before it is the last piece there. The ids are read
backwards from the end of this table.

Two neighbours are compatible if, while both come about by their own merges, no
merge across their border is ever the best. Both are taken apart again from the last
merge backwards; the pieces that touch the border at one time are looked up among
the pairs that the vocabulary's pieces are made of. Pieces whose making does not go
by ascending rank (equal scores, such as runs of blanks) are merged step by step.

No piece goes on beyond a blank or holds a tab or line feed, so such places cut a
text into units, whichever the vocabulary's own are; short units are kept for a while
by each Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.frames import chunks, extended, plus, texts
from shelfwise.llm.hashing import piece_hashes, run_starts

#: How the library writes a blank.
BLANK = "▁"
#: Bytes of text that are encoded at once.
BATCH_BYTES = 1 << 20
#: Units whose ids one Python worker keeps, of at most so many bytes each, and
#: pairs of pieces it knows to be compatible or not.
KEPT_UNITS, KEPT_BYTES, KEPT_PAIRS = 300_000, 64, 1_000_000

_UNKNOWN = -1
_ENCODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
_DECODED = T.StructType([T.StructField("decoded", T.StringType())])


class Vocabulary:
    """Pieces of a model, the two parts that each is merged from last, and tests
    of neighbours."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor) -> None:
        self.size = len(model)
        known = [i for i in range(self.size) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in known):
            raise ValueError("the model has pieces that the library takes apart again after merging")
        self.ids = {model.id_to_piece(i): i for i in known}
        self.text = {i: piece for piece, i in self.ids.items()}
        self.length = {i: len(piece) for i, piece in self.text.items()}
        self.rank = {i: -model.get_score(i) if self.length[i] > 1 else float("-inf") for i in known}
        self.byte_ids = {}
        for i in range(self.size):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[3:-1], 16)] = i
        self.unknown = model.unk_id()
        self._take_apart()
        self.compatible: dict[int, bool] = {}

    def merge(self, symbols: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """The library's merges, one by one: what is left, and the last pair merged."""
        last = None
        while len(symbols) > 1:
            best = None
            for i in range(len(symbols) - 1):
                made = self.ids.get(symbols[i] + symbols[i + 1])
                if made is not None and (best is None or self.rank[made] < best[0]):
                    best = (self.rank[made], i)  # the leftmost of equal ones
            if best is None:
                break
            i = best[1]
            last = (symbols[i], symbols[i + 1])
            symbols = [*symbols[:i], last[0] + last[1], *symbols[i + 2 :]]
        return symbols, last

    def _take_apart(self) -> None:
        self.parts: dict[int, tuple[int, int]] = {}  # of pieces that merging their characters gives
        self.pairs: dict[int, int] = {}
        ranks = sorted(r for r in self.rank.values() if r != float("-inf"))
        repeated = {a for a, b in zip(ranks, ranks[1:]) if a == b}
        self.odd: set[int] = set()  # a merge in their making has the rank of another piece or a lesser one than before
        self.automaton = ahocorasick.Automaton()
        for i in sorted(self.ids.values(), key=lambda i: self.length[i]):
            if self.length[i] > 1:
                left, last = self.merge(list(self.text[i]))
                if len(left) > 1 or any(part not in self.ids for part in last):
                    continue  # never comes about
                a, b = (self.ids[part] for part in last)
                self.parts[i] = (a, b)
                self.pairs[a * self.size + b] = i
                ascending = max(self.rank[a], self.rank[b]) < self.rank[i]
                if not ascending or self.rank[i] in repeated or a in self.odd or b in self.odd:
                    self.odd.add(i)
            self.automaton.add_word(self.text[i], (self.length[i], i))
        if self.ids:
            self.automaton.make_automaton()
        inner = {c for piece in self.ids for c in piece}
        #: Bytes of ASCII that no piece holds (a blank is another character by
        #: then), and whether blanks occur at the beginnings of pieces only.
        self.alone = [c for c in range(128) if chr(c) not in inner and c != 32]
        self.cut_at_blanks = not any(BLANK in piece.lstrip(BLANK) for piece in self.ids)

    def touches(self, a: int, b: int) -> bool:
        """Whether a and b stay as they are side by side, by taking both apart."""
        above_a = above_b = float("inf")
        start = (a, b)
        while True:
            made = self.pairs.get(a * self.size + b)
            if made is not None:
                if made in self.odd:
                    break
                # of merges of one rank the leftmost comes first: a's own before, b's own after
                if self.rank[made] < above_a and self.rank[made] <= above_b:
                    return False
            if self.rank[a] >= self.rank[b]:
                if a not in self.parts:
                    return True
                above_a, a = self.rank[a], self.parts[a][1]
            else:
                above_b, b = self.rank[b], self.parts[b][0]
        return self.stepwise(*start)

    def stepwise(self, a: int, b: int) -> bool:
        """The same by merging the characters of both."""
        return self.merge(list(self.text[a] + self.text[b]))[0] == [self.text[a], self.text[b]]

    def fits(self, a: int, b: int) -> bool:
        key = a * self.size + b
        found = self.compatible.get(key)
        if found is None:
            if len(self.compatible) >= KEPT_PAIRS:
                self.compatible.clear()
            found = self.stepwise(a, b) if a in self.odd or b in self.odd else self.touches(a, b)
            self.compatible[key] = found
        return found

    def table(self, unit: str) -> list[int]:
        """The last piece of each prefix, from one character on; _UNKNOWN where the
        last character belongs to no piece."""
        last = [_UNKNOWN] * (len(unit) + 1)
        if not self.ids:
            return last
        for at, (length, piece) in self.automaton.iter(unit):  # the longest that ends at a place first
            if last[at + 1] == _UNKNOWN:
                before = last[at + 1 - length]
                if before == _UNKNOWN or self.fits(before, piece):
                    last[at + 1] = piece
        return last

    def encode(self, unit: str) -> list[int]:
        last, at, found = self.table(unit), len(unit), []
        while at:
            piece = last[at]
            if piece == _UNKNOWN:
                at -= 1
                data = unit[at].encode("utf-8", "replace")
                found += [self.byte_ids[b] for b in reversed(data)] if self.byte_ids else [self.unknown]
            else:
                at -= self.length[piece]
                found.append(piece)
        return found[::-1]


class Encoder:
    """Ids of whole texts as the library gives them, four bytes an id. The library
    brings texts into its normal form and puts ids together to texts again."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.vocabulary = Vocabulary(self.model)
        self.kept: dict[int, bytes] = {}

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which bytes begin a unit; a blank is one byte here."""
        start = np.zeros(len(data), bool)
        start[offsets[:-1][offsets[:-1] < len(data)]] = True
        if self.vocabulary.cut_at_blanks:
            start |= run_starts(data == 32, offsets[:-1])
        for c in self.vocabulary.alone:
            at = np.flatnonzero(data == c)
            if len(at):
                start[at] = True
                start[at[at + 1 < len(data)] + 1] = True
        return start

    def encode(self, rows: list[bytes], begin: bool = True, end: bool = True) -> list[np.ndarray]:
        """UTF-8 bytes in; bytes that are none become U+FFFD."""
        mark = BLANK.encode()
        normal = [self.model.normalize(t.decode("utf-8", "replace")).encode().replace(mark, b" ") for t in rows]
        offsets = np.cumsum([0, *map(len, normal)])
        whole = b"".join(normal)
        data = np.frombuffer(whole, np.uint8)
        start = self._starts(data, offsets)
        first = np.flatnonzero(start)
        hashes = piece_hashes(data, np.ones(len(data), bool), start)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        ends = np.append(first[1:], len(data))
        found = []
        for key, i in zip(distinct.tolist(), sample.tolist(), strict=True):
            ids = self.kept.get(key)
            if ids is None:
                unit = whole[first[i] : ends[i]]
                ids = np.array(self.vocabulary.encode(unit.decode().replace(" ", BLANK)), "<u4").tobytes()
                if len(unit) <= KEPT_BYTES:
                    if len(self.kept) >= KEPT_UNITS:
                        self.kept.clear()
                    self.kept[key] = ids
            found.append(ids)
        count = np.array([len(f) // 4 for f in found], np.int64)
        place = np.cumsum(count) - count
        joined = np.frombuffer(b"".join(found), "<u4")
        size = count[which]
        last = np.cumsum(size)
        ids = joined[np.repeat(place[which] - (last - size), size) + np.arange(last[-1] if len(last) else 0)]
        cuts = np.append(0, last)[np.searchsorted(first, offsets)]
        head = np.array([self.model.bos_id()] if begin else [], "<u4")
        tail = np.array([self.model.eos_id()] if end else [], "<u4")
        return [np.concatenate([head, ids[a:b], tail]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def decode(self, rows: list[bytes]) -> list[str]:
        return self.model.decode([np.frombuffer(r, "<u4").tolist() for r in rows]) if rows else []


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and model."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, model: str, text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """Adds ids (little-endian unsigned 32-bit integers) and n_tokens to each row,
    one row out for each row in.

    `model` is the path of a SentencePiece BPE model that all executors see. Null
    texts are empty ones, which have the begin and end ids only. Columns of the
    input that clash with the added ones are replaced, the text column itself too.
    Units of a text are known by 64-bit hashes, see `hashing`.
    """
    own = docs
    if text.lower() in ("ids", "n_tokens"):  # an added column replaces it
        own, text = docs.withColumn("_encoded_text", docs[f"`{text}`"]), "_encoded_text"
    kept, schema = extended(own, _ENCODED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in chunks(batches, text, BATCH_BYTES):
            ids = coder.encode(texts(batch.column(text)), begin, end)
            yield plus(
                batch,
                {
                    "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                },
            )

    return kept.mapInArrow(run, schema).drop("_encoded_text")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Adds decoded, the text that the library makes of each row's ids; null ids
    give an empty text."""
    kept, schema = extended(encoded, _DECODED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in chunks(batches, ids, BATCH_BYTES):
            found = coder.decode([v or b"" for v in batch.column(ids).to_pylist()])
            yield plus(batch, {"decoded": pa.array(found, pa.string())})

    return kept.mapInArrow(run, schema)
