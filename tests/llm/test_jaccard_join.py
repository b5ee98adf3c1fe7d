"""Near duplicates against a comparison of all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from shelfwise.llm import jaccard_join
from shelfwise.llm.components import components


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def direct(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        common = len(x & y)
        if common and 100 * common >= 80 * (len(x) + len(y) - common):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets)


def mutated(source, words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        i, kind = source.randrange(len(words) + 1), source.random()
        if kind < 0.4 and i < len(words):
            words[i] = source.choice(vocabulary)
        elif kind < 0.7 and i < len(words):
            del words[i]
        else:
            words.insert(i, source.choice(vocabulary))
    return words


def sample(seed):
    source = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(300)] + ["É", "x y", "z\x85"]
    passage = source.choices(vocabulary, k=60)
    texts = []
    for _ in range(40):
        words = source.choices(vocabulary, k=source.choice([1, 3, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 120, 300]))
        texts.append(words + passage * (source.random() < 0.3))
        for _ in range(source.randint(0, 6)):
            few = max(1, len(words) // 40)
            texts.append(mutated(source, source.choice(texts[-4:]), vocabulary, source.choice([0, 0, 1, 1, 2, few, few + 1])))
    texts += [source.choices(vocabulary, k=source.randint(5, 40)) + passage for _ in range(80)]
    chain = source.choices(vocabulary, k=300)
    texts += [chain[:n] for n in [*range(5, 50), *range(100, 300, 12)]]
    rows = [(i, source.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]
    rows += [(10**6, None), (10**6 + 1, " \n"), (10**6 + 2, ""), (10**6 + 3, rows[0][1].lower()), (10**6 + 4, "word " * 20000)]
    source.shuffle(rows)
    return rows


@pytest.mark.parametrize("spare", [0.15, 0.0])
def test_components_are_those_of_all_pairs(spark, monkeypatch, spare):
    """Without spare segments, sets with empty segments need deletions or empty keys."""
    monkeypatch.setattr(jaccard_join, "SPARE", spare)
    rows = sample(1 if spare else 2)
    docs = spark.createDataFrame([(i, t, 3, "clash") for i, t in rows], "doc_id long, text string, n int, SET string")
    found = jaccard_join.near_duplicates(docs.repartition(3))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(tuple(r)[:3] for r in found.collect()) == direct(rows)


def test_empty_table(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pigeonhole_holds_for_all_sizes():
    tops = jaccard_join.band_tops(3000)
    for x in range(1, 2001):
        band = int(np.searchsorted(tops, x))
        differ = max((x + y) // 9 for y in range(x, x * 5 // 4 + 1))
        assert jaccard_join.need(x) == differ + 1 <= jaccard_join.segments(tops[band])
        for y in (x, x * 5 // 4):  # the larger partner is indexed under the smaller one's band
            own = jaccard_join.schemes(np.array([y]))
            assert band in [int(b[0]) for _, b, _ in own]


def test_every_set_asks_for_enough_keys():
    source = np.random.default_rng(1)
    for n in range(1, 40):
        sets = [np.unique(source.integers(0, 2**63, n).astype(np.uint64)) for _ in range(200)]
        rows, bands, _ = jaccard_join.schemes(np.full(200, n))[0]
        spare, _ = jaccard_join.demands(sets, rows, bands)
        assert min(spare) >= 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5), (900, 7), (7, 900)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {5: 5, **{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, 900, *range(300, 400)]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def links(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    n = dict.fromkeys([i for i, _ in sets], 0)
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        common = len(x & y)
        if common and 100 * common >= 80 * (len(x) + len(y) - common):
            n[a] += 1
            n[b] += 1
    return n


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_every_link_is_counted_once(spark, monkeypatch, block):
    """Groups of near copies have all their links, whatever joined them before;
    small blocks put the sets of a cluster into many tasks, some of them empty."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rows = sample(3)
    source = random.Random(5)
    words = source.choices([f"V{i}" for i in range(300)], k=120)
    rows += [(2 * 10**6 + i, " ".join(mutated(source, words, ["a", "b", "c"], i % 3))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.near_duplicates(docs.repartition(3))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    n = links(rows)
    assert sorted(tuple(r) for r in found.collect()) == [(i, s, c, n[i]) for i, s, c in direct(rows)]


def test_links_of_repeated_rows_and_rows_without_id(spark):
    text = "one two three four five six seven"
    rows = [(4, text), (4, text), (2, text.upper()), (None, text), (9, "other words are here now"), (7, None)]
    found = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = [(4, 3, 2, 1), (4, 3, 2, 1), (2, 3, 2, 1), (None, 3, None, 0), (9, 1, 9, 0), (7, 0, 7, 0)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
