"""Passages of a benchmark against a direct search."""

import random
import re

from shelfwise.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spans_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [m.span() for m in WORD.finditer(lowered)], [m.group() for m in WORD.finditer(lowered)]


def direct(text, items, n=10):
    at, words = spans_of(text)
    hit, found = set(), set()
    for item, body in items:
        own = spans_of(body)[1]
        size = min(n, len(own))
        if item is None or not size:
            continue
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(item)
    spans = []
    for i in sorted(hit):
        if spans and i - 1 in hit:
            spans[-1] = (spans[-1][0], at[i][1])
        else:
            spans.append(at[i])
    return len(words), len(hit), sorted(found), spans


def sample():
    source = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["É", "naïve", "Zwölf", "X9", "中"]
    items = [(str(i), " ".join(source.choices(words, k=source.choice([1, 2, 5, 10, 11, 30])))) for i in range(12)]
    items += [("none", ""), ("null", None), (None, "w1 w2"), ("0", items[0][1]), ("twin", items[4][1])]
    docs = [(None, None), (1, ""), (2, " .,- "), (3, "w1 " * 30000)]
    for i in range(80):
        text = []
        for _ in range(source.randint(0, 4)):
            text += source.choices(words, k=source.randint(0, 9))
            text += (source.choice(items)[1] or "").split()
        docs.append((10 + i, source.choice(["", "¡ "]) + "".join(w.upper() + source.choice([" ", ", ", "\n--", "_"]) for w in text)))
    return items, docs + docs[-3:]


def check(spark, block_bytes):
    items, docs = sample()
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, N_HIT string, spans int")
    bench = spark.createDataFrame([(t, i, 0) for i, t in items], "text string, item_id string, n_words int")
    found = contamination.find_passages(frame.repartition(3), bench, block_bytes=block_bytes)
    assert found.columns == ["doc_id", "text", "n_words", "n_hit", "item_ids", "spans"]
    got = sorted(((r.doc_id or 0, r.text or "", r.n_words, r.n_hit, r.item_ids, [tuple(s) for s in r.spans]) for r in found.collect()), key=str)
    assert got == sorted(((i or 0, t or "", *direct(t, items)) for i, t in docs), key=str)
    assert any(g[3] for g in got)


def test_one_pass(spark):
    check(spark, 1 << 20)


def test_several_passes(spark):
    check(spark, 300)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id string, text string")
    assert contamination.find_passages(docs, bench).first().n_hit == 0
    assert contamination.find_passages(docs.where("false"), bench).count() == 0
