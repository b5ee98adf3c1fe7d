"""Runs against a comparison of all periods at all places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import periodic_runs, queries


def direct(words, least_length=24, least_exponent=3):
    """Stretches in which words p apart are identical, by their smallest p."""
    n, found = len(words), {}
    for p in range(1, n // least_exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least_length, least_exponent * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((start, length, p) for (start, length), p in found.items() if smallest(words[start : start + length]) == p)


def smallest(words):
    return next(p for p in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[p:])))


def collapsed(words, runs):
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def repetitive(source, alphabet):
    words = []
    for _ in range(source.randint(0, 6)):
        root = source.choices(alphabet, k=source.randint(1, 12))
        if source.random() < 0.3:
            root = root * 3 + source.choices(alphabet, k=2)
        words += root * source.randint(1, 9) + root[: source.randint(0, len(root))]
        words += source.choices(alphabet, k=source.randint(0, 5))
    return words


@pytest.mark.parametrize("least", [(24, 3), (2, 2), (1, 4)])
def test_all_runs_are_found(least):
    source = random.Random(1)
    for size in (1, 2, 3, 8):
        alphabet = list(range(1, size + 1))
        some = [repetitive(source, alphabet) for _ in range(40)] + [source.choices(alphabet, k=60) for _ in range(20)]
        found = periodic_runs.find_runs([np.array(s, np.int64) for s in some], size + 1, *least)
        expected = [(i, *run) for i, s in enumerate(some) for run in direct(s, *least)]
        assert sorted(map(tuple, found.tolist())) == expected


def test_extensions_are_common_prefixes():
    source = random.Random(2)
    some = [source.choices([1, 2], k=source.randint(1, 30)) for _ in range(12)]
    found = periodic_runs.Extensions([[*s, 0] for s in some], 3)
    places = [(i, j) for i, s in enumerate(some) for j in range(len(s) + 1)]
    a, b = np.triu_indices(len(places), 1)
    for x, y, n in zip(a.tolist(), b.tolist(), found.common(a, b).tolist(), strict=True):
        (i, j), (k, m) = places[x], places[y]
        p, q = some[i][j:], some[k][m:]
        same = next((t for t, (u, v) in enumerate(zip(p, q)) if u != v), min(len(p), len(q)))
        assert n == (same if i == k else 0)
    order = [some[i][j:] + [0] for i, j in sorted(places, key=lambda p: found.rank[places.index(p)]) if i == 0]
    assert order == sorted(order)


def test_operator_over_all_kinds_of_texts(spark):
    source = random.Random(3)
    texts = [" ".join(f"w{w}" for w in repetitive(source, range(9))) for _ in range(60)]
    texts += [" ".join(f"w{w}" for w in source.choices(range(30), k=2000)) + "  \n" + "é 中 \t" * 400 for _ in range(3)]
    texts += [None, "", " \n ", "one", "a " * 24, "a " * 23, "a b " * 12, "a " * 30_000, "x\x0by\x85 " * 30]
    texts += [" ".join(map(str, range(500))) + " a b c" * 200, "\x00 " * 40, " a  b" * 20, " a  b" * 20]
    rows = [(i if i != 5 else None, t, 1, "mine") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Runs int, collapsed string")
    found = periodic_runs.collapse(docs.repartition(3))
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = found.withColumn("best", periodic_runs.most_periods(F.col("runs"))).collect()
    assert len(got) == len(rows)
    for row in got:
        words = split(row.text)
        runs = direct(words) if len(words) < 10_000 else [(0, 30_000, 1)]
        assert (row.n_words, [tuple(r) for r in row.runs]) == (len(words), runs)
        assert row.collapsed == collapsed(words, runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r), default=None)
        assert (row.best and tuple(row.best)) == best


def test_empty_table_and_clashing_text(spark):
    docs = spark.createDataFrame([("a " * 30,)], "runs string")
    assert periodic_runs.collapse(docs, "runs").first().collapsed == "a"
    assert periodic_runs.collapse(docs.where("false"), "runs").count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_row(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = direct(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r), default=(None, None, None))
    return (
        doc_id,
        len(runs),
        *best,
        None if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
        sha(collapsed(words, runs)),
    )


def test_query_plants_and_finds_periodic_ends(spark, tmp_path):
    source = random.Random(6)
    rows = [(i, " ".join(source.choices(["a", "b", "é", "d,", "中"] * 9 + [f"v{k}" for k in range(60)], k=source.randint(0, 300)))) for i in range(150)]
    rows += [(i, None if i % 2 else " \n") for i in range(150, 250)] + [(None, "a b " * 20), (7, None), (7, "x " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = [expected_row(i, t) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert sum(e[1] > 0 for e in expected) > 10
