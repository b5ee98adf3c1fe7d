"""Edge values of the column expressions, with hand-computed results."""

import math
import random
import re
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.config import ListingConfig
from shelfwise.functions import exact, listing, text
from shelfwise.operators import clean
from shelfwise.operators.comoments import comoments
from shelfwise.operators.features import add_features
from shelfwise.operators.keys import with_number_key
from shelfwise.plans import transform
from shelfwise.schema import LAKE_SCHEMA, NA_TOKENS


def apply(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_na_tokens(spark):
    kept = [" NA ", "na", "none", "0", "Null"]
    got = apply(spark, text.na_to_null, NA_TOKENS + kept + [None])
    assert got == [None] * len(NA_TOKENS) + kept + [None]


NUMBERS = {
    "12": 12.0, " 12 ": 12.0, "\t7\n": 7.0, "1e3": 1000.0, "+5": 5.0, "-5.5": -5.5, ".5": 0.5, "5.": 5.0,
    "inf": math.inf, "-Infinity": -math.inf, " inf ": None, "1e400": None, "1,000": None, "₹3": None, "1d": None, "1f": None,
    "0x1p3": None, "True": None, "": None, ".": None, "1 2": None, "1e": None, "nan": None, None: None,
}


def test_numbers(spark):
    assert apply(spark, text.to_number, list(NUMBERS)) == list(NUMBERS.values())


def test_numbers_like_pandas(spark):
    rng = random.Random(1)
    signs = "00123456789+-.eE dfxinfaN,_\t"
    texts = sorted({"".join(rng.choice(signs) for _ in range(rng.randrange(1, 6))) for _ in range(5000)})
    texts = [t for t in texts if not re.search(r"[eE]\+?\d{3}", t)]  # pandas gives 0e400 up, 0.0 here
    expected = pd.to_numeric(pd.Series([*texts, "not a number"], dtype=object), errors="coerce")
    for text_, got, value in zip(texts, apply(spark, text.to_number, texts), expected):
        assert (got is None) == math.isnan(value), text_
        assert got is None or got == pytest.approx(value, rel=1e-14), text_


def test_texts_like_pandas(spark):
    rng = random.Random(2)
    texts = pd.Series(["".join(rng.choice("aB \t\n  é-x") for _ in range(rng.randrange(9))) for _ in range(500)])
    slugs = texts.str.lower().str.strip().str.replace(r"\s+", "-", regex=True)
    assert apply(spark, text.slug, texts.tolist()) == slugs.tolist()
    assert apply(spark, text.word_count, texts.tolist()) == texts.str.split().str.len().tolist()


IDENTIFIERS = {
    "12": 12, "12.0": 12, "1.2e1": 12, " 12 ": 12, "-3": -3, "9007199254740993": 9007199254740993,
    "9007199254740994.0": 9007199254740994, "12.5": None, "x": None, "inf": None, "1e300": None,
    "99999999999999999999": None, None: None,
}

NUMBER_KEYS = {
    "12": "12", "12.0": "12", "1.2e1": "12", " +012.00\t": "12", "120e-1": "12", "-3": "-3", "-0.0": "0", "0e9": "0",
    "1.5": "15e-1", "2.5": "25e-1", ".5": "5e-1", "5.": "5", "1e3": "1000", "1e300": "1e300", "-1e-7": "-1e-7",
    "99999999999999999999": "99999999999999999999", "88888888888888888888": "88888888888888888888",
    "9007199254740994.0": "9007199254740994", "9007199254740993": "9007199254740993", "inf": "inf", "-Infinity": "-inf",
    "1e9999999999": "1e9999999999", "20e9999999998": "2e9999999999", "-1e-9999999999": "-1e-9999999999", "x": None,
    "1e" + "9" * 17: "1e" + "9" * 17, "10e" + "9" * 17: "1e1" + "0" * 17, "1e+0" + "9" * 40: "1e" + "9" * 40 + "e0",
    "2e-" + "9" * 40: "2e-" + "9" * 40 + "e0", "0e" + "9" * 40: "0", "1e0030": "1" + "0" * 30, "1e31": "1e31",
    "123456789012345678901.50": "1234567890123456789015e-1", "-000000000000000000012": "-12", "": None, "1,000": None, "1d": None, None: None,
}


def test_number_keys(spark):
    assert apply(spark, text.number_key, list(NUMBER_KEYS)) == list(NUMBER_KEYS.values())


def test_keys_of_a_column_are_those_of_the_expression(spark):
    rows = spark.createDataFrame([(t, 1) for t in NUMBER_KEYS], "product_id string, other int")
    got = with_number_key(rows, F.col("product_id"), "key", "id").collect()
    assert [r.key for r in got] == list(NUMBER_KEYS.values())
    assert [r.id for r in got] == [int(k) if k and k.lstrip("-").isdigit() and abs(int(k)) < 2**63 else None for k in NUMBER_KEYS.values()]
    assert got[0].asDict().keys() == {"product_id", "other", "key", "id"}


def test_typing_compiles_in_one_piece(spark, tmp_path):
    """The steps of a key are no copies of each other: generated code stays below the
    8000 bytes to which the JVM compiles a method, and far from the 64 KB of Spark."""
    path = f"{tmp_path}/raw"
    spark.createDataFrame([], LAKE_SCHEMA).write.parquet(path)
    raw = spark.read.schema(LAKE_SCHEMA).parquet(path)
    typed = clean.clean_prices(clean.enforce_schema(raw))
    featured = add_features(clean.fill_missing(typed, 1.0))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # or a plan has no code before it runs
    try:
        for df in (clean.enforce_schema(raw), featured, transform.process(raw, ListingConfig(discount_fill="zero"))):
            plan = df._jdf.queryExecution().executedPlan()
            code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", code)]
            assert sizes and 0 < min(sizes) and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_identifiers(spark):
    assert apply(spark, text.to_identifier, list(IDENTIFIERS)) == list(IDENTIFIERS.values())


PRICES = {
    "₹3,995.00": 3995.0, "Rs. 500": 0.5, "-5": 5.0, "1.2.3": None, ".": None, "": None, "1e-05": 105.0,
    "Price on request": None, None: None,
}


def test_prices(spark):
    assert apply(spark, text.parse_price, list(PRICES)) == list(PRICES.values())


def test_slugs(spark):
    values = ["  Women   Kurtas ", "A\tB c", "one", "   ", "", None]
    assert apply(spark, text.slug, values) == ["women-kurtas", "a-b-c", "one", "", "", None]


def test_word_counts(spark):
    values = ["  a  b ", "a\tb\nc", "", "   ", "one", None]
    assert apply(spark, text.word_count, values) == [2, 3, 0, 0, 1, None]


def test_price_buckets(spark):
    values = [0.0, 499.99, 500.0, 1999.99, 2000.0, 4999.99, 5000.0, None]
    assert apply(spark, listing.price_bucket, values, "double") == [
        "budget", "budget", "mid_range", "mid_range", "premium", "premium", "luxury", "unknown",
    ]


def test_rating_tiers(spark):
    values = [5.5, 4.5, 4.49, 4.0, 3.99, 3.0, 2.99, -1.0, None]
    assert apply(spark, listing.ratings_tier, values, "double") == [
        "excellent", "excellent", "good", "good", "average", "average", "poor", "poor", "unknown",
    ]


def test_discount_bands_have_gaps(spark):
    values = [0.0, -3.0, 9.99, 10.0, 19.0, 19.5, 20.0, 29.5, 30.0, 49.0, 49.5, 50.0, None]
    assert apply(spark, listing.discount_band, values, "double") == [
        "0%", "1–9%", "1–9%", "10–19%", "10–19%", "50%+", "20–29%", "50%+", "30–49%", "30–49%",
        "50%+", "50%+", "50%+",
    ]


def test_richness(spark):
    got = apply(spark, listing.listing_richness, [0, 4, 5, 9, 10, None], "int")
    assert got == ["sparse", "sparse", "moderate", "moderate", "rich", "rich"]


def test_null_stays_null(spark):
    assert apply(spark, lambda x: listing.clamp(x, 0.0, 5.0), [-1.0, 0.0, 5.5, None], "double") == [
        0.0, 0.0, 5.0, None,
    ]
    assert apply(spark, listing.non_negative, [-1.0, 2.0, None], "double") == [0.0, 2.0, None]


def test_popularity(spark):
    rows = [(4.5, 994.0), (5.5, 0.0), (3.0, -1.0), (0.0, -1.0), (3.0, -2.0), (None, 5.0), (3.0, None)]
    got = [
        r[0]
        for r in spark.createDataFrame(rows, "r double, n double")
        .coalesce(1)
        .select(listing.popularity(F.col("r"), F.col("n")))
        .collect()
    ]
    assert got == [round(4.5 * math.log1p(994), 4), 0.0, -math.inf, None, None, None, None]


@pytest.mark.parametrize("values, expected", [([0.005, 0.015], 0.01), ([857.67, 857.68], 857.68), ([], None)])
def test_exact_average_rounds_half_up(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(exact.exact_avg("x", 2)).first()[0] == expected


def test_huge_values_fall_back_to_doubles(spark):
    df = spark.createDataFrame([(1e300,), (1.0,)], "x double")
    assert df.agg(exact.exact_sum("x", 2)).first()[0] == 1e300
    infinite = spark.createDataFrame([(math.inf,), (1.0,)], "x double")
    assert infinite.agg(exact.exact_avg("x", 2)).first()[0] == math.inf


def test_exact_sum_does_not_depend_on_partitions(spark):
    df = spark.range(20000).select((F.col("id") * 0.01).alias("x"))
    sums = {df.repartition(n).agg(exact.exact_sum("x", 2)).first()[0] for n in (1, 3, 8)}
    assert sums == {1999900.0}


def test_large_sums_are_exact(spark):
    """Totals beyond 30 digits, in any partitioning."""
    values = [9e27] * 200 + [-1.5, 0.25] * 30
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for parts in (1, 7):
        row = frame.repartition(parts).agg(exact.exact_avg("v", 2), exact.exact_sum("v", 2)).first()
        own = sum(map(fraction_of, values))
        assert tuple(row) == (rounded(own / len(values), 2), rounded(own, 2))


@pytest.mark.parametrize("digits", [0, 2, 6])
def test_partial_sums_of_very_many_rows_are_divided_exactly(spark, digits):
    rng = random.Random(digits)
    rows = [(rng.choice([-1, 1]) * rng.randrange(10 ** rng.randint(1, 37)), rng.randrange(10**38) % 10 ** rng.randint(1, 38), n)
            for n in (1, 7, 10**11, 2 * 10**11 + 1, 10**13) for _ in range(40)]
    rows += [(-3, 0, 2), (1, 5 * 10**24, 10), (0, 0, 10**12), (10**11, 0, 2 * 10**11)]
    text = [(str(w), f"{f // 10**25}.{f % 10**25:025d}", n) for w, f, n in rows]
    sums = spark.createDataFrame(text, "w string, f string, n long").coalesce(1)
    got = sums.select(F.expr(exact.divided("w", "f", "n", digits)))
    expected = [rounded((w + Fraction(f, 10**25)) / n, digits) for w, f, n in rows]
    assert [r[0] for r in got.collect()] == expected


def test_comoments_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(1)
    rows = [(rng.uniform(0, 90), rng.gauss(3, 1) * 10 ** rng.randint(-3, 3)) for _ in range(3000)] + [(None, 1.0), (2.0, None)]
    frame = spark.createDataFrame(rows, "a double, b double")
    found = {tuple(comoments(frame.repartition(n).orderBy(F.rand(n)), "a", "b").first()) for n in (1, 2, 5, 8)}
    assert len(found) == 1
    both = [(Fraction(a), Fraction(b)) for a, b in rows if a is not None and b is not None]
    mx, my = (sum(column) / len(both) for column in zip(*both))
    expected = [mx, my, sum((a - mx) ** 2 for a, _ in both), sum((b - my) ** 2 for _, b in both), sum((a - mx) * (b - my) for a, b in both)]
    assert list(found.pop()) == pytest.approx([float(e) for e in expected], rel=1e-12)


def test_comoments_of_tiny_constant_and_no_values(spark):
    tiny = spark.createDataFrame([(i * 1e-200, (i % 7) * 1e150) for i in range(50)], "a double, b double")
    row = comoments(tiny, "a", "b").first()
    plain = comoments(spark.createDataFrame([(float(i), float(i % 7)) for i in range(50)], "a double, b double"), "a", "b").first()
    assert row.xy == pytest.approx(plain.xy * 1e-50, rel=1e-9) and plain.yy == pytest.approx(sum((i % 7 - 2.94) ** 2 for i in range(50)))
    same = comoments(spark.createDataFrame([(0.0, 2.0)] * 3, "a double, b double"), "a", "b").first()
    assert tuple(same) == (0.0, 2.0, 0.0, 0.0, 0.0)
    assert tuple(comoments(tiny.where("false"), "a", "b").first()) == (None,) * 5


def test_percent(spark):
    rows = spark.createDataFrame([(1, 3), (1, 8), (0, 0)], "a long, b long").coalesce(1)
    got = [r[0] for r in rows.select(exact.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [33.3, 12.5, None]


def fraction_of(value):
    return Fraction(repr(value))


def rounded(value, digits):
    scaled = abs(value) * 10**digits
    units = int(scaled + Fraction(1, 2))
    return float(Fraction(units if value >= 0 else -units, 10**digits))


EXACT_SETS = [
    [0.0049999999] * 3, [4e-7] * 5000, [1e12, 0.01, 0.02], [1e15 + 0.5, -1e15, 0.125], [0.125, 0.125], [-0.125], [-0.3, 5.0],
    [0.1] * 10, [2.675], [1.005, 1.005], [1e22, 1.5, -1e22], [123456789012.34, 0.01], [-2.5, -0.05], [1e-9, 2e-9], [0.0], [7.0, None],
]


@pytest.mark.parametrize("digits", [0, 1, 2, 6])
def test_sums_and_averages_are_rounded_once(spark, digits):
    rng = random.Random(digits)
    sets = EXACT_SETS + [[rng.choice([-1, 1]) * round(rng.uniform(0, 10 ** rng.randrange(12)), rng.randrange(9)) for _ in range(50)] for _ in range(20)]
    rows = [(i, v) for i, own in enumerate(sets) for v in own]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "i int, v double").repartition(3)
    got = frame.groupBy("i").agg(exact.exact_avg("v", digits).alias("a"), exact.exact_sum("v", digits).alias("s"))
    for r in got.collect():
        own = [fraction_of(v) for v in sets[r.i] if v is not None]
        assert (r.a, r.s) == (rounded(sum(own) / len(own), digits), rounded(sum(own), digits)), sets[r.i][:5]


def test_sums_of_nothing_and_of_infinities(spark):
    frame = spark.createDataFrame([(1, None), (2, math.inf), (2, 1.0), (3, 1e300), (3, 1e300)], "i int, v double")
    got = frame.groupBy("i").agg(exact.exact_avg("v", 2).alias("a"), exact.exact_sum("v", 2).alias("s")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, None, None), (2, math.inf, math.inf), (3, 1e300, 2e300)]
