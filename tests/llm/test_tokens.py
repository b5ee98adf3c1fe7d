"""Token ids, record files and packing against the tokenizers library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import packing, queries, token_records
from shelfwise.llm.encoding import Encoder
from shelfwise.session import scratch_dir

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
ROWS = [
    (3, "It's plain: 12 words,  two blanks\n\nand the rest"),
    (1, None),
    (2, ""),
    (5, "Éé naïve “quotes” — 中文 é <|endoftext|> ½"),
    (5, "Éé naïve “quotes” — 中文 é <|endoftext|> ½"),
    (9, "word " * 9000),
    (4, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "left", 7, "other") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, part int, KEY string").repartition(3)


def library(kind, text, end):
    ids = Tokenizer.from_file(public_tokenizers.path(FILES[kind])).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


@pytest.mark.parametrize("kind", FILES)
def test_encoder_gives_what_the_library_gives(kind):
    encoder = Encoder(public_tokenizers.path(FILES[kind]), kept=300)
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
    source = random.Random(4)
    for alphabet in (" \n\t\r aAbBéÉ'sStmdreveLL.,!19ßñ-_", " '\nsrle.", " aÉ'́ 　१𝒜ΣςİıǅK<|>endoftext\x1c²½“—…×÷"):
        for _ in range(300):
            texts = ["".join(source.choices(alphabet, k=source.randint(0, 14))) for _ in range(4)]
            got = encoder.encode([t.encode() for t in texts])
            assert [g.tolist() for g in got] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_records_come_back(spark, docs):
    path = f"{scratch_dir(spark)}/tokens"
    token_records.write_records(docs, path, public_tokenizers.path(FILES["byte"]), end_id=2)
    read = token_records.read_records(spark, path)
    rows = read.join(token_records.read_index(spark, path), ["part", "offset"]).select(read.key, "start", "ids", read.n_tokens).collect()
    start = 0
    expected = []
    for key, text in sorted(ROWS, key=lambda r: (r[0], r[1] or "")):
        ids = library("byte", text, 2)
        expected.append((key, start, ids.tobytes(), len(ids)))
        start += len(ids)
    assert sorted((r[0], r[1], bytes(r[2]), r[3]) for r in rows) == sorted(expected)


def test_selected_records_are_read_at_their_offsets(spark, docs):
    path = f"{scratch_dir(spark)}/tokens"
    token_records.write_records(docs, path, public_tokenizers.path(FILES["byte"]), end_id=2)
    wanted = token_records.read_index(spark, path).where("key in (5, 9)")
    got = token_records.read_selected(spark, path, wanted).collect()
    assert sorted(r.key for r in got) == [5, 5, 9]
    assert {(r.key, bytes(r.ids)) for r in got} == {(k, library("byte", t, 2).tobytes()) for k, t in ROWS if k in (5, 9)}


def test_records_of_an_empty_table(spark, docs):
    path = f"{scratch_dir(spark)}/tokens"
    token_records.write_records(docs.where("false"), path, public_tokenizers.path(FILES["byte"]), end_id=2)
    assert token_records.read_index(spark, path).count() == 0


def test_rows_without_a_key_are_refused(spark):
    docs = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="doc_id is null"):
        token_records.write_records(docs, f"{scratch_dir(spark)}/x", public_tokenizers.path(FILES["byte"]), end_id=2)


def test_damaged_records_are_found():
    data = token_records.record(7, np.array([1, 2, 70], "<u2")) + b"\n"
    payload, following = token_records.unframe(data, 0)
    assert token_records.parse(payload)[0] == 7 and following == len(data)
    for i in range(len(data) - 1):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(bytes(broken), 0)
    with pytest.raises(ValueError):
        token_records.unframe(data[:-3], 0)


def test_pieces_hold_every_id_once(spark, docs):
    pieces = packing.pack(docs, public_tokenizers.path(FILES["word"]), end_id=1, pool_ids=5000).collect()
    want = sorted((k, library("word", t, 1).tobytes()) for k, t in ROWS)
    # repeated rows cannot be told apart by id, so their pieces are counted
    for key in {k for k, _ in ROWS}:
        own = sorted((r.start, bytes(r.ids)) for r in pieces if r.doc_id == key)
        copies = [ids for k, ids in want if k == key]
        assert sum(len(b) for _, b in own) == sum(map(len, copies))
        assert all(ids[4 * start : 4 * start + len(b)] == b for start, b in own for ids in copies)
    sequences = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert sequences.get(r.sequence_id, 0) == r.offset and r.length * 4 == len(r.ids)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values())
    assert {r.sequence_id: r.window for r in pieces} == sequences


def test_packing_nothing(spark, docs):
    assert packing.pack(docs.where("false"), public_tokenizers.path(FILES["word"]), end_id=1).count() == 0


def test_tiers_are_filled_from_shorter_ones():
    lengths = [5000, 1500, 500, 40, 8, 700, 300, 2048, 1, 260]
    windows = packing.pack_pool(lengths)
    covered = sorted((i, s, n) for _, pieces in windows for i, s, n in pieces)
    for i, total in enumerate(lengths):
        at = 0
        for _, start, n in [c for c in covered if c[0] == i]:
            assert start == at
            at += n
        assert at == total
    assert all(sum(n for _, _, n in pieces) == window for window, pieces in windows)
    mixed = next(p for w, p in windows if w == 2048 and p[0] == (1, 0, 1500))
    assert mixed[1] == (2, 0, 500) and mixed[2] == (3, 0, 40) and mixed[3] == (4, 0, 8)


def test_step_groups_are_balanced():
    source = random.Random(1)
    windows = packing.pack_pool([source.randint(1, 6000) for _ in range(2000)])
    groups = packing.step_groups(windows, 8)
    by_group = {}
    for (window, pieces), group in zip(windows, groups):
        by_group.setdefault(group, []).append((window, sum(n * n for _, _, n in pieces)))
    assert all(len(own) <= 8 and len({w for w, _ in own}) == 1 for own in by_group.values())
    full = [sum(c for _, c in own) for own in by_group.values() if len(own) == 8 and own[0][0] == 2048]
    assert max(full) < 1.3 * min(full)


def test_tiers_must_be_powers_of_two(spark, docs):
    with pytest.raises(ValueError):
        packing.pack(docs, "x", 1, tiers=(2048, 1000))


def test_query_digests(spark, docs):
    pieces = packing.pack(docs.where("doc_id = 3"), public_tokenizers.path(FILES["word"]), end_id=1)
    row = pieces.select("ids", F.crc32("ids").alias("crc")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))


def test_rows_without_a_key_are_written_and_returned(spark, tmp_path):
    rows = [(None, "b c"), (3, "x"), (None, None), (0, "zero"), (None, "a"), (-4, "minus")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(queries.op1_token_records(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    ordered = [(None, None), (None, "a"), (None, "b c"), (-4, "minus"), (0, "zero"), (3, "x")]
    expected = [(key, library("byte", text, 2)) for key, text in ordered]
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == [(k, len(i), zlib.crc32(i.tobytes())) for k, i in expected]
    assert [r.start for r in got] == np.cumsum([0, *[len(i) for _, i in expected]])[:-1].tolist()


@pytest.mark.parametrize("longest", [3000, 30])
def test_files_stay_below_what_spark_reads_as_one_value(spark, monkeypatch, longest):
    """All rows share one key, many the text too: several files, none longer than allowed."""
    monkeypatch.setattr(token_records, "LINE_BYTES", 700)
    monkeypatch.setattr(token_records, "FILE_BYTES", 2000)
    path = f"{scratch_dir(spark)}/small"
    own = [f"text {i} " + "word " * (i % 90) for i in range(300)] + ["the same words"] * 300 + ["long " * longest]
    docs = spark.createDataFrame([(7, t) for t in own] + [(8, "last")], "doc_id long, text string")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "7000")  # the long text alone takes 6000
    try:
        token_records.write_records(docs, path, public_tokenizers.path(FILES["byte"]), end_id=2)
        rows = token_records.read_records(spark, path).join(token_records.read_index(spark, path).select("part", "offset", "start"), ["part", "offset"]).orderBy("start").collect()
        some = token_records.read_index(spark, path).where("start % 3 = 0")
        picked = token_records.read_selected(spark, path, some).select("part", "offset", "ids").collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    expected = sorted(library("byte", t, 2).tobytes() for t in [*own, "last"])
    assert sorted(bytes(r.ids) for r in rows) == expected and [r.key for r in rows] == [7] * 601 + [8]
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    by_place = {(r.part, r.offset): r.ids for r in rows}
    assert len(picked) == some.count() and all(by_place[r.part, r.offset] == r.ids for r in picked)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.part, []).append(r.length)
    assert len(sizes) > 10 and all(sum(of) <= 2000 or len(of) == 1 for of in sizes.values())
