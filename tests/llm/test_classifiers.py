"""Quality and toxicity models: held-out labels, identities, odd input."""

import math
import pickle
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import quality_classifier, toxicity
from shelfwise.llm.frames import joined

SMALL = "/root/testdata/sf0.01"
ODD = [(10**7, None), (10**7 + 1, ""), (10**7 + 2, "   "), (10**7 + 3, "x" * 200000), (10**7 + 4, "é"), (10**7 + 4, "é")]


def area(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable")) + 1
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def held_out(spark, frame, label, n, rest):
    got = frame.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").toPandas()
    got = got[[zlib.crc32(str(i).encode()) % n == rest for i in got.doc_id]]
    return got.score.to_numpy(), got[label].to_numpy()


def fold(n):
    return F.crc32(F.col("doc_id").cast("string")) % n


def tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", F.lit(9).alias("SCORE"), F.lit("a").alias("value"))
    odd = spark.createDataFrame([(i, t, 1, "b") for i, t in ODD], "doc_id long, text string, SCORE int, value string")
    return docs.union(odd), spark.read.parquet(f"{SMALL}/labels.parquet")


def check_odd(scored):
    odd = scored.where(F.col("doc_id") >= 10**7).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.text in (None, "")}) == 1


def test_quality(spark):
    docs, labels = tables(spark)
    model = quality_classifier.train(docs, labels, fold(5) != 0)
    scored = quality_classifier.add_scores(docs, model)
    assert scored.columns == ["doc_id", "text", "value", "score"]
    assert area(*held_out(spark, scored, "quality", 5, 0)) > 0.97
    check_odd(scored)


def test_toxicity(spark):
    docs, labels = tables(spark)
    model = toxicity.train(docs, labels, fold(4) != 2)
    scored = toxicity.add_scores(docs, model)
    assert scored.columns == ["doc_id", "text", "value", "score"]
    scores, truth = held_out(spark, scored, "toxic", 4, 2)
    assert area(scores, truth) > 0.6  # there are 51 toxic documents to learn from
    assert (scores[truth == 0] >= 0.3).mean() < 0.05
    check_odd(scored)


def test_toxicity_in_several_passes(spark, monkeypatch):
    pairs = spark.createDataFrame([(k, float(k % 7)) for k in range(1, 4000, 3)], "key long, delta float")
    word = np.linspace(0, 1, toxicity.VOCABULARY, dtype=np.float32)
    text = "a b c d e " * 3
    hashed = toxicity.pairs(*joined(pa.array([text])))[1]
    known = spark.createDataFrame([(int(k), 2.0) for k in set(hashed.tolist())], "key long, delta float")
    model = toxicity.Model(word, pairs.union(known))
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    once = {r.doc_id: r.value for r in toxicity.add_values(docs, model).collect()}
    monkeypatch.setattr(toxicity, "BLOCK_PAIRS", 500)
    often = {r.doc_id: r.value for r in toxicity.add_values(docs, model).collect()}
    expected = float((word[hashed & (toxicity.VOCABULARY - 1)].astype(float) + 2).mean())
    assert once == pytest.approx({1: expected, 2: 0.0}) and often == pytest.approx(once)


def test_clear_words_decide(spark):
    rows = [(i, f"you {'nasty creep' if i % 4 == 0 else 'nice person'} went home number{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, F.lit(True))
    new = spark.createDataFrame([(1, "a nasty thing"), (2, "a nice thing"), (3, "unheard of")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.add_scores(new, model).collect()}
    assert scores[1] > 0.5 > scores[3] >= scores[2]


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, labels, F.lit(True))
    assert all(abs(r.score - 0.5) < 0.05 for r in quality_classifier.add_scores(docs, model).collect())
    assert {r.score for r in toxicity.add_scores(docs, toxicity.train(docs, labels, F.lit(True))).collect()} == {0.5}
    none = docs.where("false")
    assert quality_classifier.add_scores(none, model).count() == 0
    assert toxicity.add_scores(none, toxicity.train(none, labels, F.lit(True))).count() == 0


def test_pair_terms_equal_the_sum_over_pairs():
    random = np.random.default_rng(3)
    size = quality_classifier.BUCKETS + quality_classifier.STATISTICS
    model = quality_classifier.Model(
        0.3, random.normal(size=size), random.normal(size=(size, 3)), np.zeros(quality_classifier.STATISTICS), np.ones(quality_classifier.STATISTICS)
    )
    rows, dims, values, statistics = quality_classifier.features(*joined(pa.array(["one two two, Three!", None, "x"])))
    got = quality_classifier.score(model, rows, dims, values, statistics)
    for i in range(3):
        x = np.zeros(size)
        x[dims[rows == i]] = values[rows == i]
        x[quality_classifier.BUCKETS :] = np.clip(statistics[i], -4, 4)
        used = np.flatnonzero(x)
        pairs = sum(model.factors[a] @ model.factors[b] * x[a] * x[b] for n, a in enumerate(used) for b in used[n + 1 :])
        assert got[i] == pytest.approx(model.bias + model.weights @ x + pairs)


def test_distributions_sum_to_one():
    random = np.random.default_rng(4)
    n = toxicity.VOCABULARY
    words = [random.poisson(0.01, n).astype(float), random.poisson(0.1, n).astype(float), random.poisson(0.1, n).astype(float)]
    tables = toxicity.estimate(words, [np.zeros(n)] * 4, [(10, 3), (20, 5)])
    assert [w.sum() for w in tables.word] == pytest.approx([1, 1], abs=1e-6)


def test_words_that_share_leading_bits_keep_their_own_counts(spark):
    """A toxic word counts by itself, whatever ordinary word has its first 20 bits."""

    def leading(words):
        return toxicity.pairs(*joined(pa.array(words)))[1] & (toxicity.VOCABULARY - 1)

    names = [f"w{i}" for i in range(4000)]
    first = {}
    numbers = leading(names).tolist()
    bad, good = next((names[first[n]], names[i]) for i, n in enumerate(numbers) if first.setdefault(n, i) != i)
    rows = [(i, f"{bad if i % 4 == 0 else good} x{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, F.lit(True))
    new = spark.createDataFrame([(1, bad), (2, good)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.add_scores(new, model).collect()}
    assert scores[1] > 0.5 > scores[2]


def kneser_ney(texts):
    """Values of texts by the two models, from dictionaries of words. `texts` = (text, toxic)."""
    n, before = [Counter(), Counter()], {}
    for text, toxic in texts:
        for pair in zip(["", *text.split()], text.split()):
            n[1 - toxic][pair] += 1
            before.setdefault(pair[1], set()).add(pair[0])
    words, after, types, discount = ([Counter(), Counter()] for _ in range(4))
    for c in (0, 1):
        for (h, w), count in n[c].items():
            words[c][w] += count
            after[c][h] += count
            types[c][h] += 1
        one, two = (sum(1 for x in n[c].values() if x == times) for times in (1, 2))
        discount[c] = min(max(one / max(one + 2 * two, 1), 0.1), 0.95)
    tokens = [sum(words[c].values()) for c in (0, 1)]
    follows, vocabulary = sum(map(len, before.values())), len(before) + 1

    def single(c, w):
        shared = (len(before[w]) + 1) / (follows + vocabulary)
        return max(words[c][w] - discount[c], 0) / tokens[c] + discount[c] * len(words[c]) / tokens[c] * shared

    def double(c, h, w):
        if not after[c][h]:
            return single(c, w)
        return max(n[c][h, w] - discount[c], 0) / after[c][h] + discount[c] * types[c][h] / after[c][h] * single(c, w)

    def telling(a, b, all_a, all_b):
        share, statistic = (a + b) / max(all_a + all_b, 1), 0.0
        for x, whole in ((a, all_a), (b, all_b)):
            for part, mean in ((x, whole * share), (whole - x, whole * (1 - share))):
                statistic += 2 * part * math.log(part / mean) if part else 0
        return statistic >= toxicity.SIGNIFICANT

    def difference(h, w):
        if w not in before:
            return 0.0
        if n[0][h, w] + n[1][h, w] >= 2 and telling(n[0][h, w], n[1][h, w], after[0][h], after[1][h]):
            return math.log(double(0, h, w)) - math.log(double(1, h, w))
        return math.log(single(0, w) / single(1, w)) if telling(words[0][w], words[1][w], *tokens) else 0.0

    def value(text):
        own = text.split()
        return sum(difference(h, w) for h, w in zip(["", *own], own)) / max(len(own), 1)

    return value


@pytest.mark.parametrize("block", [toxicity.BLOCK_PAIRS, 2])
def test_values_are_those_of_the_two_models(spark, monkeypatch, block):
    """All terms at once, and in several passes over the documents."""
    monkeypatch.setattr(toxicity, "BLOCK_PAIRS", block)
    source = random.Random(8)
    common = [f"word{i}" for i in range(30)]
    rows = []
    for i in range(400):
        toxic = int(i % 4 == 0)
        text = source.choices(common, k=source.randint(5, 30))
        text += source.choices(["vile", "foul"] if toxic else ["kind", "calm"], k=2)
        for _ in range(2):  # two words that are no sign by themselves, but one after the other
            text += ["bad", "apple"] if toxic else ["bad", source.choice(common), "apple"]
            text.append(source.choice(common))
        rows.append((" ".join(text), toxic))
    labelled = spark.createDataFrame(rows, "text string, label int").repartition(3)
    counts = labelled.mapInArrow(toxicity._counted, "h long, w long, n0 long, n1 long")
    counts = counts.groupBy("h", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    model = toxicity.Terms(toxicity._terms(counts))
    assert model.terms.count() > 4
    asked = [text for text, _ in rows[:60]] + ["", "unseen words only", "bad apple", "apple bad", "vile bad apple word1 word2", "kind"]
    got = toxicity.add_values(spark.createDataFrame([(t,) for t in asked], "text string"), model).collect()
    direct = kneser_ney(rows)
    assert {r.text: r.value for r in got} == pytest.approx({t: direct(t) for t in asked}, abs=1e-5)
    assert direct("bad apple") > direct("apple bad") + 0.5 and direct("vile") > 0.5 > -0.5 > direct("kind")


def whole_model(texts):
    """Values of texts by the two models with all words and pairs, from dictionaries."""
    n, before = [Counter(), Counter(), Counter()], {}
    for text, toxic in texts:
        for pair in zip(["", *text.split()], text.split()):
            n[1 - toxic][pair] += 1
            n[2][pair] += 1
            before.setdefault(pair[1], set()).add(pair[0])
    words, after, types, discount = ([Counter(), Counter(), Counter()] for _ in range(4))
    for c in range(3):
        for (h, w), count in n[c].items():
            words[c][w] += count
            after[c][h] += count
            types[c][h] += 1
        one, two = (sum(1 for x in n[c].values() if x == times) for times in (1, 2))
        discount[c] = min(max(one / max(one + 2 * two, 1), 0.1), 0.95)
    follows, vocabulary = sum(map(len, before.values())), len(before) + 1

    def single(c, w):
        tokens, shared = sum(words[c].values()), (len(before.get(w, ())) + 1) / (follows + vocabulary)
        return max(words[c][w] - discount[c], 0) / tokens + discount[c] * len(words[c]) / tokens * shared

    def double(c, h, w):
        if not after[2][h]:
            return single(c, w)
        back = discount[2] * types[2][h] / after[2][h]
        direct = max(n[2][h, w] - discount[2], 0) / (after[2][h] - discount[2] * types[2][h])
        if after[c][h]:
            direct = (max(n[c][h, w] - discount[c], 0) + discount[c] * types[c][h] * direct) / after[c][h]
        return (1 - back) * direct + back * single(c, w)

    def value(text):
        own = text.split()
        return sum(math.log(double(0, h, w) / double(1, h, w)) for h, w in zip(["", *own], own)) / max(len(own), 1)

    return value, double, [w for w in words[2] if words[2][w]]


@pytest.mark.parametrize("block, passes", [(toxicity.BLOCK_PAIRS, 4), (200, 100), (200, 1)])
def test_all_words_and_pairs_count(spark, monkeypatch, block, passes):
    """In one pass, in several and by a join; pairs seen once and words that both classes
    have alike add their difference too, and copies of a text change nothing."""
    monkeypatch.setattr(toxicity, "BLOCK_PAIRS", block)
    monkeypatch.setattr(toxicity, "PASSES", passes)
    source = random.Random(9)
    common = [f"word{i}" for i in range(30)]
    rows = [(" ".join(source.choices(common, k=source.randint(3, 9)) + [f"new{i}"]), int(i % 3 == 0)) for i in range(150)]
    labelled = spark.createDataFrame(rows, "text string, label int").repartition(3)
    counts = labelled.mapInArrow(toxicity._counted, "h long, w long, n0 long, n1 long")
    model = toxicity._all_terms(counts.groupBy("h", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    value, double, known = whole_model(rows)
    asked = [text for text, _ in rows[:40]] + ["word1 word1 word1", "word1 word1 word1", "unseen word2", "", " ,;"]
    docs = spark.createDataFrame([(t,) for t in [*asked, None]], "text string")
    got = [(r.text, r.value) for r in toxicity.add_values(docs, model).collect()]
    assert sorted(t or "" for t, _ in got) == sorted([*asked, ""])
    for text, found in got:
        assert found == pytest.approx(value((text or "").replace(",;", "")), abs=1e-5)
    for c in (0, 1):  # each a distribution: known words, and one number for the unknown
        for h in ("", "word1", "unseen"):
            assert sum(double(c, h, w) for w in [*known, "unseen"]) == pytest.approx(1)


def pair_table(n):
    """Pairs in order of first and second word, each with the counts of its first word."""
    random_ = np.random.default_rng(5)
    words = np.sort(random_.integers(-(2**63), 2**63 - 1, n // 8))
    at = np.unique(random_.zipf(1.3, n) % len(words) * len(words) + random_.integers(0, len(words), n))
    h, w = words[at // len(words)], words[at % len(words)]
    counts = {"n0": random_.poisson(0.1, len(at)), "n1": 1 + random_.poisson(0.2, len(at))}
    first, of_h = np.unique(h, return_inverse=True)
    for c in (0, 1):
        counts[f"a{c}"] = np.bincount(of_h, counts[f"n{c}"]).astype(int)[of_h]
        counts[f"t{c}"] = np.bincount(of_h, counts[f"n{c}"] > 0).astype(int)[of_h]
    counts["t"] = np.bincount(of_h)[of_h]
    of_words = {"w": words, "a0": random_.poisson(1, len(words)), "a1": random_.poisson(9, len(words)), "before": random_.poisson(9, len(words))}
    return pa.table({"h": h, "w": w, **counts}), of_words


@pytest.mark.parametrize("packed, mixed", [(1 << 16, False), (50, False), (50, True)])
def test_packed_block_has_each_pair(monkeypatch, packed, mixed):
    """Also if the pairs of a first word are packed in several parts, in any order of these;
    a pair takes less than half of the 20 bytes that its two hashes and value had."""
    monkeypatch.setattr(toxicity, "PACKED_PAIRS", packed)
    table, words = pair_table(20000)
    totals = toxicity.Totals((2e3, 2e4), (1e3, 2e3), (0.7, 0.8), 2e4, len(words["w"]) + 1, 0.6)
    made = toxicity._packer(SimpleNamespace(value=words["w"]))(table.to_batches(max_chunksize=20))
    parts = [(b.column(0)[0].as_py(), b.column(1)[0].as_py()) for b in made]
    if mixed:
        parts = parts[::2] + parts[1::2]
    data = pickle.dumps(toxicity.Block(toxicity._packed(words), parts, totals))
    block = pickle.loads(data)
    if packed > 50:
        assert len(parts) == 1 and len(parts[0][0]) + len(parts[0][1]) < 10 * len(table)
    of = {c: table.column(c).to_numpy() for c in table.column_names}
    second = np.searchsorted(words["w"], of["w"])
    number = block.number[np.searchsorted(block.history, of["h"])]
    of_w = words["a0"][second], words["a1"][second]
    expected = totals.seen((of["n0"], of["n1"]), (of["a0"], of["a1"]), (of["t0"], of["t1"]), of["t"], of_w, words["before"][second])
    assert block.added(number, second) == pytest.approx(expected, abs=1e-5)
    there = set(zip(of["h"].tolist(), second.tolist()))
    other = np.array([(h, w) for h in set(of["h"][:200].tolist()) for w in range(100) if (h, w) not in there])
    assert len(other) and not block.added(block.number[np.searchsorted(block.history, other[:, 0])], other[:, 1]).any()


def test_pairs_are_shuffled_once_to_meet_their_first_words(spark):
    counts = spark.createDataFrame([(1, 2, 1, 0), (1, 3, 0, 2), (1, 2, 1, 1), (4, 2, 0, 1)], "h long, w long, n0 long, n1 long")
    summed = counts.repartition("h").groupBy("h", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = toxicity._with_histories(summed)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert sorted(map(tuple, got.collect())) == [(1, 2, 2, 1, 2, 3, 1, 2, 2), (1, 3, 0, 2, 2, 3, 1, 2, 2), (4, 2, 0, 1, 0, 1, 0, 1, 1)]
