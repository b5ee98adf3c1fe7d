"""Operators against numpy, pandas or hand-computed results."""

import itertools
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.config import ListingConfig
from shelfwise.operators import clean, counts
from shelfwise.operators.dedup import keep_latest, without_superseded
from shelfwise.operators.features import add_features
from shelfwise.operators.median import exact_median
from shelfwise.operators.union import union_by_name
from shelfwise.plans.transform import identified, latest_versions, process, step_counters
from shelfwise.schema import LAKE_SCHEMA, PROCESSED_SCHEMA, RAW_COLUMNS


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def raw_rows(spark, rows):
    """Raw lake rows from dictionaries; order of the list is order of arrival."""
    columns = LAKE_SCHEMA.fieldNames()
    full = [{"_batch_id": 0, "_row_id": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in full], LAKE_SCHEMA)


# --- median -----------------------------------------------------------------


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [1.0, 1.0, 9.0, 9.0], [None, 4.0]])
def test_median_of_few(spark, values):
    expected = float(np.median([v for v in values if v is not None]))
    assert exact_median(frame(spark, values), F.col("x")) == expected


def test_median_of_nothing(spark):
    assert exact_median(frame(spark, [None, None]), F.col("x")) is None


def _samples():
    rng = np.random.default_rng(7)
    yield "uniform", rng.random(60_001) * 100
    yield "even", rng.random(60_000)
    yield "skewed", np.exp(rng.normal(0, 5, 50_000))
    yield "hot", np.where(rng.random(50_000) < 0.4, 7.25, rng.random(50_000) * 100)
    yield "hot median", np.concatenate([np.full(30_000, 5.0), rng.random(20_000) * 10])
    yield "two camps", np.concatenate([rng.random(20_000), 1e9 + rng.random(20_000)])
    yield "infinite", np.concatenate([rng.random(30_000), np.full(5_000, np.inf), np.full(4_000, -np.inf)])


@pytest.mark.parametrize("name, values", list(_samples()), ids=lambda v: v if isinstance(v, str) else "")
def test_median_by_narrowing(spark, name, values):
    """A low limit forces brackets, which must not cost exactness."""
    df = frame(spark, values.tolist())
    assert exact_median(df, F.col("x"), max_values=50) == float(np.median(values))


# --- newest version ---------------------------------------------------------


def test_keep_latest_any_arrival(spark):
    rows = [{"product_id": p, "title": f"{p}-{i}"} for i, p in enumerate(["1", "2", "1", None, "2", None])]
    expected = {("1", "1-2"), ("2", "2-4"), (None, "None-5")}
    raw = raw_rows(spark, rows)
    for order in itertools.islice(itertools.permutations(range(6)), 0, 720, 180):
        shuffled = raw.orderBy(F.element_at(F.lit(list(order)), (F.col("_row_id") + 1).cast("int")))
        got = {(r.product_id, r.title) for r in keep_latest(shuffled).collect()}
        assert got == expected
    again = keep_latest(raw)
    assert sorted(keep_latest(again).collect(), key=str) == sorted(again.collect(), key=str)


def test_keep_latest_limits_before_the_shuffle(spark):
    plan = keep_latest(raw_rows(spark, [{"product_id": "1"}]))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_keep_latest_needs_an_order(spark):
    with pytest.raises(ValueError):
        keep_latest(spark.range(1).withColumnRenamed("id", "product_id"))


@pytest.mark.parametrize("groups", [1, 3, 1 << 18])
def test_superseded_rows_are_dropped_before_the_sort(spark, groups):
    """Whatever the number of groups, each key keeps its newest rows, with missing keys,
    keys without any time, some rows without, and ties of the first order column."""
    source = random.Random(4)
    rows = [
        {"product_id": source.choice(["1", "2", "3", "4", None]), "_ingested_at": datetime(2024, 1, source.randint(1, 20)), "title": str(i)}
        for i in range(200)
    ]
    rows += [{"product_id": "1", "title": "no time"}] + [{"product_id": p, "title": "never"} for p in ("5", "5", "6")]
    rows += [{"product_id": "2", "_ingested_at": datetime(2024, 1, 20), "title": "tie"} for _ in range(2)]
    raw = raw_rows(spark, rows)
    kept = without_superseded(raw, "product_id", groups=groups)
    assert kept.columns == raw.columns
    assert sorted(keep_latest(kept).collect(), key=str) == sorted(keep_latest(raw).collect(), key=str)
    timed = raw.where("product_id IN ('1', '2', '3', '4')")
    assert without_superseded(timed, "product_id", groups=groups).count() < timed.count() / 2


def test_latest_versions_sort_what_is_left(spark):
    """The wide rows meet the bounds before the group limit sorts them."""
    plan = latest_versions(raw_rows(spark, [{"product_id": "1"}]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.rsplit("WindowGroupLimit", 1)[1]


# --- cleaning ---------------------------------------------------------------


def test_price_falls_back_to_list_price(spark):
    rows = [{"initial_price": "10", "final_price": p} for p in ["₹1,234.50", "on request", None]]
    rows.append({"initial_price": None, "final_price": "."})
    got = clean.clean_prices(clean.enforce_schema(raw_rows(spark, rows))).orderBy("_row_id").collect()
    assert [r.final_price for r in got] == [1234.5, 10.0, 10.0, None]


def test_discount_fill_sees_superseded_rows(spark):
    rows = [{"product_id": "1", "discount": d} for d in ["10", "20", "x", "90"]] + [{"product_id": "2"}]
    raw = raw_rows(spark, rows)
    assert clean.discount_fill_value(raw) == 20.0
    assert clean.discount_fill_value(raw, ListingConfig(discount_fill="zero")) == 0.0
    done = {r.product_id: r.discount for r in process(raw).collect()}
    assert done == {1: 90.0, 2: 20.0}


def test_no_discount_at_all(spark):
    (row,) = process(raw_rows(spark, [{"product_id": "1"}])).collect()
    assert row.discount is None and row.is_discounted is False


def test_defaults(spark):
    (row,) = process(raw_rows(spark, [{"product_id": "1", "what_customers_said": "mixed"}])).collect()
    assert (row.seller_name, row.videos, row.variations, row.seller_information) == (
        "Unknown Seller", "none", "none", "unknown",
    )
    assert row.what_customers_said == 0.0
    assert (row.has_seller, row.has_variations, row.price_bucket, row.ratings_tier) == (
        False, False, "unknown", "unknown",
    )
    assert row.category_slug is None and row.title_word_count is None


def test_features_see_the_unclamped_rating(spark):
    rows = [{"product_id": "1", "rating": "6", "ratings_count": "10"}, {"product_id": "2", "rating": "-1"}]
    got = {r.product_id: r for r in process(raw_rows(spark, rows)).collect()}
    assert got[1].rating == 5.0 and got[1].rating_x_count == round(6 * np.log1p(10), 4)
    assert got[2].rating == 0.0 and got[2].ratings_tier == "poor"


def test_step_order_does_not_matter_for_row_wise_steps(spark):
    """Dropping old versions first gives what cleaning everything first gives."""
    rng = random.Random(3)
    rows = [
        {
            "product_id": str(rng.randrange(20)) if rng.random() < 0.9 else None,
            "rating": str(rng.uniform(-1, 6)),
            "discount": str(rng.randrange(60)) if rng.random() < 0.7 else None,
            "final_price": f"₹{rng.randrange(9000):,}",
            "initial_price": str(rng.randrange(9000)),
        }
        for _ in range(300)
    ]
    raw = raw_rows(spark, rows)
    everything = clean.fill_missing(
        clean.clean_prices(clean.enforce_schema(identified(raw))), clean.discount_fill_value(raw)
    )
    late = clean.validate(clean.drop_metadata(keep_latest(add_features(everything), "product_key")))
    columns = PROCESSED_SCHEMA.fieldNames()
    assert sorted(process(raw).collect(), key=str) == sorted(late.select(*columns).collect(), key=str)


def test_processed_columns_and_surplus(spark):
    raw = raw_rows(spark, [{"product_id": "1"}]).withColumn("brand", F.lit("b"))
    done = process(raw)
    assert done.columns == [*PROCESSED_SCHEMA.fieldNames(), "brand"]
    assert [f.dataType for f in done.schema.fields[:-1]] == [f.dataType for f in PROCESSED_SCHEMA.fields]


def test_step_counters(spark):
    raw = raw_rows(
        spark,
        [{"product_id": "1", "rating": "9"}, {"product_id": "1", "rating": "7"}, {"product_id": "2", "rating": "3"}],
    )
    assert step_counters(raw, process(raw)).first().asDict() == {
        "raw_rows": 3, "duplicates_removed": 1, "ratings_clamped": 1, "output_rows": 2,
    }


# --- counts -----------------------------------------------------------------


def test_domain_counts(spark):
    df = frame(spark, ["b", "b", "z", None], "string")
    assert [tuple(r) for r in counts.domain_counts(df, "x", ["a", "b"]).collect()] == [("a", None), ("b", 2)]
    assert [tuple(r) for r in counts.domain_counts(df, "x", ["a", "b"], keep_absent=False).collect()] == [("b", 2)]


def _histograms():
    rng = np.random.default_rng(5)
    yield "random", rng.random(3000) * 37
    yield "edges", np.arange(0, 201) / 10.0
    yield "tenths", np.round(rng.random(3000) * 5, 1)
    yield "hundredths", np.round(rng.random(3000) * 4.89 + 0.11, 2)
    yield "constant", np.full(10, 3.5)


@pytest.mark.parametrize("name, values", list(_histograms()), ids=lambda v: v if isinstance(v, str) else "")
def test_histogram_is_numpys(spark, name, values):
    rows = counts.histogram(frame(spark, values.tolist() + [None]), "x").collect()
    expected, edges = np.histogram(values, bins=20)
    assert [r["count"] for r in rows] == expected.tolist()
    assert [r.lower for r in rows] == pytest.approx(edges[:-1].tolist(), abs=1e-12)
    assert rows[-1].upper == edges[-1]


def test_histogram_of_nothing(spark):
    assert counts.histogram(frame(spark, [None]), "x").collect() == []


# --- union ------------------------------------------------------------------


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "t")], "product_id string, title string")
    b = spark.createDataFrame([("s", "2")], "seller string, product_id string")
    got = union_by_name([a, b]).orderBy("product_id").collect()
    assert [tuple(r) for r in got] == [("1", "t", None), ("2", None, "s")]
    with pytest.raises(ValueError):
        union_by_name([])


def test_raw_columns_are_strings():
    assert {LAKE_SCHEMA[c].dataType.simpleString() for c in RAW_COLUMNS} == {"string"}
