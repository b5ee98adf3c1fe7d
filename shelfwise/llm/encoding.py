"""Token ids of texts, each distinct piece encoded once for a while per task.

A byte-pair tokenizer first cuts a text into pieces (words, numbers, blanks) and
encodes each apart. The pieces of many texts are found with numpy and looked up
by a 64-bit hash; the library encodes those not met before.
"""

from __future__ import annotations

import json
import os

import numpy as np

from shelfwise.llm.hashing import LOWER, byte_set, piece_hashes

#: Bytes of text that are encoded at once.
BATCH_BYTES = 1 << 20
#: Pieces whose ids one Python worker keeps, about 30 bytes each.
KEPT_PIECES = 1_000_000

#: Fixed value: how byte-level BPE with its own splitting cuts a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: how BPE with word ends cuts a text in lower case without its blanks.
WORD_ENDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

LETTER, DIGIT, BLANK, OTHER = 1, 2, 3, 4
_kind = np.full(256, OTHER, np.uint8)
_kind[[*range(65, 91), *range(97, 123), *range(0x80, 256)]] = LETTER
_kind[48:58] = DIGIT
_kind[[9, 10, 13, 32]] = BLANK
#: Latin letters of two bytes, plain blanks and the visible characters of ASCII.
_plain = byte_set([9, 10, 13, *range(32, 127), *range(0x80, 0xC0), *range(0xC3, 0xCA)])


def _rule(tokenizer) -> str | None:
    """"byte_level" or "word_ends" if the tokenizer cuts texts that way."""
    rules = json.loads(tokenizer.to_str())
    rule, normal = rules["pre_tokenizer"], rules["normalizer"]
    if not rule:
        return None
    if rule["type"] == "ByteLevel" and rule["use_regex"] and not rule["add_prefix_space"] and not normal:
        return "byte_level"
    if rule["type"] == "Sequence" and normal and normal["type"] == "Sequence":
        first = rule["pretokenizers"][0]
        steps = [n["type"] for n in normal["normalizers"]]
        known = first["type"] == "Split" and first["pattern"].get("Regex") == WORD_ENDS
        if known and first["behavior"] == "Removed" and first["invert"] and steps == ["NFC", "Replace", "Lowercase"]:
            return "word_ends"
    return None


def plain(text: bytes) -> bool:
    """Whether the numpy rules hold: tables of Unicode differ between libraries
    and normal forms join characters, so texts with anything but Latin letters,
    ASCII and plain blanks are left to the library, as are marks of special tokens."""
    data = np.frombuffer(text, np.uint8)
    if not _plain[data].all() or b"<|" in text:
        return False
    # multiplication and division sign are no letters; the dotted capital I has an odd lower case
    return not any(mark in text for mark in (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0"))


def piece_starts(data: np.ndarray, offsets: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to pieces and which begin one. Rows of bytes end at `offsets`."""
    n = len(data)
    kind = _kind[data]
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # 0: no byte there
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[offsets[:-1][offsets[:-1] < n]] = 0
    after[offsets[1:][offsets[1:] > 0] - 1] = 0
    seen = kind != BLANK
    space_before = np.zeros(n, bool)
    space_before[1:] = data[:-1] == 32
    space_before &= before == BLANK
    if rule == "byte_level":  # one space goes with what follows
        start = np.where(seen, (kind != before) & ~space_before, (before != BLANK) | ((after != BLANK) & (after != 0)))
        inside = np.ones(n, bool)
    else:
        start, inside = seen & ((kind != before) | (kind == DIGIT)), seen
    quote = (data == 39) & (before != OTHER)
    if rule == "byte_level":
        quote &= ~space_before
    quote = np.flatnonzero(quote)
    if len(quote):
        end = offsets[np.searchsorted(offsets, quote, "right")]
        pad = np.append(data, np.zeros(3, np.uint8))
        pad = LOWER[pad] if rule == "word_ends" else pad
        one = np.where(quote + 1 < end, pad[quote + 1], 0)
        two = np.where(quote + 2 < end, pad[quote + 2], 0)
        short = np.isin(one, list(b"stmd"))
        pair = one.astype(np.int32) * 256 + two
        long = np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])
        for found, size in ((short, 2), (long & ~short, 3)):
            at = quote[found]
            start[at + 1] = False
            rest = at + size
            rest = rest[rest < end[found]]
            start[rest] |= seen[rest]
    return inside, start


class Encoder:
    """`encode(texts)` gives the ids that the library gives for each whole text,
    UTF-8 bytes in, arrays of two or four bytes an id out."""

    def __init__(self, path: str, kept: int = KEPT_PIECES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.rule = _rule(self.tokenizer)
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)  # batches that a piece was in
        self.ids = np.zeros(0, self.dtype)

    def _shrink(self) -> None:
        """Forgets pieces that only one batch had; all, if that is not half of them."""
        kept = self.used > 1
        if 2 * kept.sum() > len(kept):
            return self._forget()
        count = self.count[kept].astype(np.int64)
        ends = np.cumsum(count)
        take = np.repeat(self.first[kept] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        self.ids = self.ids[take]
        self.keys, self.first, self.count = self.keys[kept], ends - count, self.count[kept]
        self.used = np.zeros(len(self.keys), np.int32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        found = self._library(pieces)
        count = np.array([len(f) for f in found], np.int32)
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, np.array([i for f in found for i in f], self.dtype)])
        order = np.argsort(merged := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = merged[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.used = np.concatenate([self.used, np.zeros(len(keys), np.int32)])[order]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts whose pieces the rules above find."""
        offsets = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        inside, start = piece_starts(data, offsets, self.rule)
        begin = np.flatnonzero(start)
        folded = LOWER[data] if self.rule == "word_ends" else data
        distinct, sample, which = np.unique(piece_hashes(folded, inside, start), return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.kept and len(self.keys):
            self._shrink()
        new = np.flatnonzero(~self._known(distinct))
        if len(new):
            ends = np.append(begin[1:], len(data))
            rows = np.append(offsets[1:], len(data))[np.searchsorted(offsets[1:], begin[sample[new]], "right")]
            spans = zip(begin[sample[new]].tolist(), np.minimum(ends[sample[new]], rows).tolist(), strict=True)
            whole = data.tobytes()
            self._learn(distinct[new], [whole[a:b].decode() for a, b in spans])
        at = np.searchsorted(self.keys, distinct)
        self.used[at] += 1
        at = at[which]
        count = self.count[at].astype(np.int64)
        ends = np.cumsum(count)
        take = np.repeat(self.first[at] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        ids = self.ids[take]
        cuts = np.append(0, ends)[np.searchsorted(begin, offsets)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        easy = [i for i, t in enumerate(texts) if self.rule and plain(t)]
        found: list = [None] * len(texts)
        if easy:
            for i, ids in zip(easy, self._plain([texts[i] for i in easy]), strict=True):
                found[i] = ids
        rest = [i for i, f in enumerate(found) if f is None]
        for i, ids in zip(rest, self._library([texts[i].decode() for i in rest]), strict=True):
            found[i] = np.array(ids, self.dtype)
        return found


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and tokenizer."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
