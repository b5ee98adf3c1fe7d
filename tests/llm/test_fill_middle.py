"""Rearranged texts against slices of the text itself."""

import hashlib
import random

import numpy as np
import pytest

from shelfwise.llm import fill_middle


def direct(doc_id, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((a % (n + 1), b % (n + 1)))
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if d % 100 < 20:
        return n, "spm", i, j - i, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", i, j - i, f"<P>{prefix}<S>{suffix}<M>{middle}"


def sample():
    source = random.Random(1)
    rows = [(i, "".join(source.choices("ab é中𝒜<>PSM\n", k=source.randint(0, 40)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "no key é"), (None, None), (7, "a <S> b"), (8, "x" * 9), (8, "x" * 9)]
    rows += [(2000 + i, "é𝒜b<" * 60000) for i in range(6)]
    return rows


def test_forms_and_outputs_are_those_of_slices(spark):
    docs = spark.createDataFrame([(i, t, 5, "mine") for i, t in sample()], "doc_id long, text string, N int, Output string")
    found = fill_middle.restore(fill_middle.rearrange(docs.repartition(3)))
    assert found.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    rows = found.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()
    expected = [(i, t, *direct(i, t), t or "") for i, t in sample()]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_text_column_of_any_name_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text")], "id string, output string")
    row = fill_middle.restore(fill_middle.rearrange(docs, "id", "output")).first()
    assert tuple(row) == ("1", *direct(1, "some text"), "some text")
    assert fill_middle.restore(fill_middle.rearrange(docs.where("false"), "id", "output")).count() == 0


@pytest.mark.parametrize("step", [1, 2, 7, 1 << 16])
def test_exchange_in_place(monkeypatch, step):
    monkeypatch.setattr(fill_middle, "STEP", step)
    source = random.Random(step)
    for _ in range(200):
        data = bytearray(source.randbytes(source.randint(0, 30)))
        a, b, c = sorted(source.randint(0, len(data)) for _ in range(3))
        expected = data[:a] + data[b:c] + data[a:b] + data[c:]
        fill_middle.exchange(data, a, b, c)
        assert data == expected
        text = "".join(source.choices("aé中𝒜", k=20))
        cuts = sorted(source.choices(range(21), k=3))
        assert fill_middle.scan(text.encode(), cuts) == [len(text[:k].encode()) for k in cuts]
    np.testing.assert_equal(fill_middle.points("aé中𝒜".encode()), 4)
