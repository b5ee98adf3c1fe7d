"""Repeated strings against a count of all of them."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.llm import queries, suffix_dedup


def direct(texts, length=200):
    seen = Counter(t[j : j + length] for t in texts for j in range(len(t) - length + 1))
    found = []
    for t in texts:
        covered = np.zeros(len(t) + 1, int)
        for j in range(len(t) - length + 1):
            if seen[t[j : j + length]] > 1:
                covered[j] += 1
                covered[j + length] -= 1
        covered = np.cumsum(covered)[: len(t)] > 0
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        found.append((len(t), int(covered.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~covered].tobytes()).hexdigest()))
    return found


def sample():
    source = random.Random(5)

    def noise(n):
        return "".join(source.choices("abcdefgh é\n\0", k=n))

    passages = [noise(n) for n in (150, 199, 200, 201, 230, 300, 500)]
    rows = []
    for i in range(150):
        text = noise(source.randint(0, 300))
        for _ in range(source.randint(0, 3)):
            text += source.choice(passages)[source.choice([0, 0, 0, 5, 50]) :] + noise(source.randint(0, 120))
        rows.append((i, text))
    rows += [(1000, None), (1001, ""), (1002, "a" * 4000), (1003, "ab" * 300), (1004, rows[5][1]), (1005, rows[5][1])]
    rows += [(1006, noise(9000)), (1007, noise(150) + rows[3][1] * 2), (1008, "x" * 199), (1009, "x" * 199)]
    return rows


@pytest.mark.parametrize("limit, small", [(1 << 15, 8), (1 << 15, 2), (1 << 15, 10**6), (3, 2)])
def test_removed_bytes(spark, monkeypatch, limit, small):
    """With groups transformed as they are, halved in tasks, and halved by Spark."""
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", small)
    rows = sample()
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, id int, SPANS string")
    monkeypatch.setattr(queries, "_table", lambda *_: docs.repartition(3))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, "").collect()}
    assert got == dict(zip([i for i, _ in rows], direct([(t or "").encode() for _, t in rows])))


def test_empty_table(spark):
    documents, texts = suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))
    assert documents.count() == texts.count() == 0


def test_kept_text(spark):
    source = random.Random(1)
    passage = "".join(source.choices("abcdefgh", k=250))
    docs = spark.createDataFrame([(1, f"start {passage} end"), (2, f"{passage}!")], "doc_id long, text string")
    documents, texts = suffix_dedup.remove_repeats(docs)
    kept = {r.doc_id: bytes(r.kept) for r in documents.join(texts, "id").collect()}
    assert kept == {1: b"start  end", 2: b"!"}


def test_transform_finds_all_repeats():
    source = random.Random(5)
    for _ in range(60):
        length = source.choice([3, 5, 8])
        parts = [bytes(source.choices(b"abc\0", k=source.randint(0, 40))) for _ in range(source.randint(1, 12))]
        ids = np.array([source.randint(0, 3) for _ in parts])
        starts = np.array([source.randint(0, 5) for _ in parts])
        places = defaultdict(set)
        for i, t in enumerate(parts):
            for j in range(len(t) - length + 1):
                places[t[j : j + length]].add((ids[i], starts[i] + j))
        want = {(i, j) for i, t in enumerate(parts) for j in range(len(t) - length + 1) if len(places[t[j : j + length]]) > 1}
        part, place = suffix_dedup.repeated_windows(parts, ids, starts, length)
        assert set(zip(part.tolist(), place.tolist())) == want


def test_suffix_array():
    source = np.random.default_rng(2)
    for n in (1, 2, 50, 400):
        symbols = np.append(source.integers(1, 4, n), 0).astype(np.uint16)
        text = symbols.tolist()
        assert suffix_dedup.suffix_array(symbols).tolist() == sorted(range(n + 1), key=lambda i: text[i:])


def test_equal_windows_have_equal_anchors():
    source = random.Random(3)
    shared = bytes(source.choices(b"abcd", k=200))
    for _ in range(20):
        texts = [bytes(source.choices(b"abcd", k=source.randint(0, 300))) + shared + bytes(source.choices(b"abcd", k=source.randint(0, 300))) for _ in range(2)]
        inside = []
        for t in texts:
            at, grams, _ = suffix_dedup.anchors(t)
            start = t.index(shared)
            inside.append({(p - start, g) for p, g in zip(at.tolist(), grams.tolist()) if start <= p <= start + 200 - suffix_dedup.ANCHOR})
        assert inside[0] & inside[1]
