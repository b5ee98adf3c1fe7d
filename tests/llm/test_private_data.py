"""Personal data against the plain expressions, and what contexts reveal."""

import random
import re

from pyspark.sql import functions as F

from shelfwise.llm import private_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def direct(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(found)


def test_base_spans(spark):
    source = random.Random(3)
    texts = ["".join(source.choices("aB1 23.4-+5@6789().0_%é𝒜 \n", k=source.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "a" * 100000 + "@b", "1." * 3000, "1 " * 20000, "a@b" + ".c" * 20000, "+1" * 3000]
    texts += ["4111 1111 1111 1111 x 4111111111111112 +1 (555) 123-4567 1.2.3.4.5.6.7.8 300.1.1.1 a@b.c_d@e.f 0000255.1.1.1"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    spans = private_data.digest_text(private_data.base_spans(F.coalesce("text", F.lit(""))))
    got = {r.i: r.s for r in rows.select("i", spans.alias("s")).collect()}
    assert got == {i: direct(t) for i, t in enumerate(texts)}
    assert sum(map(bool, got.values())) > 30


def frame(spark, texts):
    rows = [(i, t, "clash", 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, text string, spans string, BASE int").repartition(3)


def test_contexts_reveal_unseen_identifiers(spark):
    known = [f"lorem ipsum please write to u{i}x@mail.org for more {i % 7}" for i in range(30)]
    unseen = ["lorem ipsum please write to user_4477at.mail for more"] * 2
    plain = ["room b1234567 is free", "you went to 2024plans now and then", None, ""]
    found = private_data.find_private(frame(spark, known + unseen + plain))
    assert sorted(found.columns) == ["base", "id", "spans", "text"]
    rows = {r.id: r for r in found.withColumn("clean", private_data.redact(F.col("text"), F.col("spans"))).collect()}
    assert len(rows) == 36
    for i in range(30):
        assert [s.kind for s in rows[i].base] == ["email"] and rows[i].spans == rows[i].base
    for i in (30, 31):
        assert rows[i].base == [] and rows[i].clean == "lorem ipsum please write to [EMAIL] for more"
    for i in range(32, 36):
        assert rows[i].spans == [] and rows[i].clean == rows[i].text


def test_identifiers_of_any_length_are_found_whole(spark):
    known = [f"lorem ipsum please write to u{i}x@mail.org for more {i % 7}" for i in range(30)]
    long = ["user_4477at.mail" + "x9" * 30, "a" * 52 + "7", "b" * 5000 + "@c" + "d" * 5000, "é" * 70]
    texts = known + [f"lorem ipsum please write to {one} for more" for one in long]
    found = private_data.find_private(frame(spark, texts)).where("id >= 30").orderBy("id")
    rows = found.withColumn("clean", private_data.redact(F.col("text"), F.col("spans"))).collect()
    assert [r.clean == "lorem ipsum please write to [EMAIL] for more" for r in rows] == [True, True, True, False]
    assert rows[3].spans == []


def test_words_beyond_reach_make_no_pattern(spark):
    """Seeds beside words of which only ends are near do not make a pattern of these ends."""
    known = [f"{'z' * 60}{chr(97 + i)}please {'y' * 60}write u{i}x@mail.org" for i in range(20)]
    found = private_data.find_private(frame(spark, [*known, f"{'q' * 60}{'y' * 60}write abc123"]))
    assert [len(r.spans) for r in found.orderBy("id").collect()] == [1] * 20 + [0]


def test_few_seeds_reveal_nothing(spark):
    texts = [f"please write to u{i}x@mail.org" for i in range(2)] + ["please write to user_4477at.mail"]
    assert [len(r.spans) for r in private_data.find_private(frame(spark, texts)).orderBy("id").collect()] == [1, 1, 0]


def test_overlapping_spans_are_redacted_once(spark):
    rows = frame(spark, ["write x@10.0.0.1 or é 10.0.0.1 now"])
    row = private_data.find_private(rows).withColumn("clean", private_data.redact(F.col("text"), F.col("spans"))).first()
    assert len(row.spans) == 3 and row.clean == "write [EMAIL] or é [IP] now"


def test_empty_table(spark):
    assert private_data.find_private(frame(spark, ["x"]).where("false")).count() == 0


def test_no_python_runs(spark):
    plan = private_data.find_private(frame(spark, ["a 1.2.3.4"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
