"""Ids and texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shelfwise.llm import piece_encoding, queries
from shelfwise.llm.piece_encoding import BLANK, Encoder

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return Encoder(MODEL)


@pytest.mark.parametrize(
    "alphabet",
    [
        "ab cde stinghero\n\t.,'0123ABST",
        " ▁a",
        "   the",
        "aaab",
        "\x00\r　 é́ﬁ中文字𝒜😀�‍ <s>/x",
        "абвгде ёжзий",
        "0123456789 .-",
    ],
)
def test_ids_are_those_of_the_library(coder, library, alphabet):
    source = random.Random(len(alphabet))
    for _ in range(300):
        rows = ["".join(source.choices(alphabet, k=source.randint(0, 60))) for _ in range(5)]
        got = coder.encode([r.encode() for r in rows])
        assert [g.tolist() for g in got] == library.encode(rows, add_bos=True, add_eos=True)
        assert coder.decode([g.tobytes() for g in got]) == [library.decode(g.tolist()) for g in got]


def test_pieces_side_by_side(coder, library):
    """Texts put together from pieces hold the pairs that merging decides."""
    source = random.Random(3)
    pieces = sorted(coder.vocabulary.ids)
    for _ in range(3000):
        row = "".join(source.choices(pieces, k=source.randint(1, 6))).replace(BLANK, " ")
        assert coder.encode([row.encode()], False, False)[0].tolist() == library.encode(row), row


def test_compatible_pairs_are_those_of_merging(coder):
    words = coder.vocabulary
    source = random.Random(4)
    made = sorted(set(words.parts) - words.odd)
    for _ in range(4000):
        a, b = source.choice(made), source.choice(made)
        assert words.touches(a, b) == words.stepwise(a, b)
    for c in source.sample(made, 3000):  # parts of one piece, and of pieces that begin or end alike
        a, b = words.parts[c]
        assert not words.fits(a, b)
        d = source.choice(made)
        for pair in ((a, words.parts[d][1]), (words.parts[d][0], b), (c, b), (a, c)):
            assert words.fits(*pair) == words.stepwise(*pair)


def test_a_full_store_and_long_units(monkeypatch, library):
    monkeypatch.setattr(piece_encoding, "KEPT_UNITS", 3)
    monkeypatch.setattr(piece_encoding, "KEPT_PAIRS", 5)
    coder = Encoder(MODEL)
    rows = ["some words that are more than three", "x" * 100_000, "中文" * 30_000, " " * 5000, "word " * 20_000]
    for row in rows:
        assert coder.encode([row.encode()])[0].tolist() == library.encode(row, add_bos=True, add_eos=True)


def test_operator(spark, library):
    texts = [(1, "Some text, twice"), (1, "Some text, twice"), (2, None), (3, ""), (None, " é\n\n中 "), (4, "a▁b")]
    docs = spark.createDataFrame([(i, t, 7, "mine") for i, t in texts], "doc_id long, text string, IDS int, decoded string")
    found = piece_encoding.decode(piece_encoding.encode(docs.repartition(2), MODEL), MODEL)
    assert found.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    ids = {t: library.encode(t or "", add_bos=True, add_eos=True) for _, t in texts}
    expected = [(i, t, np.array(ids[t], "<u4").tobytes(), len(ids[t]), library.decode(ids[t])) for i, t in texts]
    rows = [(r.doc_id, r.text, bytes(r.ids), r.n_tokens, r.decoded) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert piece_encoding.decode(piece_encoding.encode(docs.where("false"), MODEL), MODEL).count() == 0
    clash = spark.createDataFrame([("Some text",)], "ids string")
    assert piece_encoding.encode(clash, MODEL, "ids").first().n_tokens == len(library.encode("Some text")) + 2


def test_query_on_given_documents(spark, library):
    """Every whole text of the smallest tables, as the library encodes and decodes it."""
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.op11_sentencepiece(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()

    def expected(doc_id, text):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        sha = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        return (doc_id, len(ids), *sha)

    assert sorted(map(tuple, rows)) == sorted(expected(*d) for d in docs)
