"""Properties of the whole transformation on random dirty feeds."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.transform import process
from shelfwise.plans.warehouse import build_star
from shelfwise.schema import LAKE_SCHEMA
from tests.test_operators import raw_rows


def dirty_feed(seed, n=400):
    rng = random.Random(seed)

    def maybe(value, missing=0.2):
        return None if rng.random() < missing else value

    return [
        {
            "product_id": rng.choice(["7", "7.0", "x", None]) if rng.random() < 0.4 else str(rng.randrange(60)),
            "category": maybe(rng.choice(["  Big  Box", "big box ", "TOY", "\ttoy"])),
            "initial_price": maybe(str(rng.randrange(1, 9000))),
            "final_price": maybe(rng.choice(["₹1,234.50", "on request", "99", "1.2.3"])),
            "discount": maybe(str(rng.randrange(0, 700) / 10)),
            "rating": maybe(str(rng.uniform(-1, 6))),
            "ratings_count": maybe(rng.choice(["n/a", "0", "15", "-1"])),
            "seller_name": maybe(rng.choice(["a", "b"]), 0.5),
            "title": maybe("word " * rng.randrange(12)),
        }
        for _ in range(n)
    ]


def rows_of(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_files_in_any_order_give_the_same_result(spark, tmp_path, seed):
    raw = raw_rows(spark, dirty_feed(seed))
    expected = rows_of(process(raw))
    for parts in (1, 3, 7):
        path = str(tmp_path / f"parts{parts}")
        raw.repartition(parts, F.hash("_row_id", F.lit(parts))).write.parquet(path)
        assert rows_of(process(spark.read.schema(LAKE_SCHEMA).parquet(path))) == expected


def test_repeated_delivery_changes_nothing(spark):
    raw = raw_rows(spark, dirty_feed(3))
    assert rows_of(process(raw.unionByName(raw))) == rows_of(process(raw))


def test_one_fact_per_identifier(spark):
    raw = raw_rows(spark, dirty_feed(4))
    star = build_star(process(raw))
    fact = star.fact_product_listing
    known, unknown = fact.agg(F.count_distinct("product_id"), F.count_if(F.col("product_id").isNull())).first()
    assert unknown == 1 and fact.count() == known + 1
    assert star.dim_product.count() == fact.count()
    assert star.dim_seller.count() == fact.select("seller_name").distinct().count()
    assert rows_of(star.dim_category.select("category_slug")) == rows_of(fact.select("category_slug").distinct())


def test_ranges(spark):
    done = process(raw_rows(spark, dirty_feed(5)))
    assert done.where("rating < 0 or rating > 5 or discount_amount < 0 or discount is null").count() == 0
