"""The whole run from CSV to published tables."""

import csv
import random
from datetime import datetime
from statistics import median

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.clean import discount_value
from shelfwise.operators.median import exact_median, merged_median
from shelfwise.plans import reports
from shelfwise.plans.quality import QualityError
from shelfwise.plans.run import ingest_csv, load, published_star, run, run_landed
from shelfwise.plans.transform import latest_versions, process
from shelfwise.schema import ATTEMPT, LAKE_SCHEMA, RAW_COLUMNS
from shelfwise.sources.lake import HOUR_COLUMNS, append_to_lake, read_lake
from shelfwise.sources.summary import discount_counts, new_rows, update_summary
from shelfwise.streaming import jobs
from tests.test_operators import raw_rows


def write_csv(path, rows):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, RAW_COLUMNS)
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def write_all(path, rows):
    """With the columns that the rows have beyond the known ones."""
    frame = pd.DataFrame(rows)
    further = [c for c in frame.columns if c not in RAW_COLUMNS]
    frame.reindex(columns=[*RAW_COLUMNS, *further]).to_csv(path, index=False)


def listing(i, price="₹1,000.00", **more):
    return {"product_id": str(i), "title": f"item {i}", "category": "c", "final_price": price, "rating": "4", **more}


def test_runs_replace_and_repeat(spark, tmp_path):
    lake, warehouse = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    source = write_csv(tmp_path / "feed.csv", [listing(i) for i in range(120)])
    star = run(spark, source, lake, warehouse, now=datetime(2024, 1, 1))
    assert reports.executive_overview(star).first().total_skus == 120
    raw = read_lake(spark, lake)
    assert sorted({r._batch_id for r in raw.collect()}) == [0, 1, 2]

    changed = write_csv(tmp_path / "next.csv", [listing(i, "₹50.00") for i in range(100, 130)])
    run(spark, changed, lake, warehouse, now=datetime(2024, 1, 2))
    run(spark, changed, lake, warehouse, now=datetime(2024, 1, 3))  # a repeat adds versions, not products
    overview = reports.executive_overview(published_star(spark, warehouse)).first()
    assert overview.total_skus == 130
    assert overview.total_revenue_potential == 100 * 1000 + 30 * 50


def test_failed_run_is_not_published(spark, tmp_path):
    lake, warehouse = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    source = write_csv(tmp_path / "feed.csv", [listing(1)])
    run(spark, source, lake, warehouse, now=datetime(2024, 1, 1))
    with pytest.raises(QualityError):
        load(spark, read_lake(spark, lake).limit(0), warehouse, "20240102")
    assert published_star(spark, warehouse).fact_product_listing.count() == 1


def test_an_ingest_repeated_changes_nothing(spark, tmp_path):
    source, lake = str(tmp_path / "feed.csv"), str(tmp_path / "lake")
    write_all(source, [listing(i, "10", discount=str(10 + i)) for i in range(8)])
    assert ingest_csv(spark, source, lake)
    before = read_lake(spark, lake).collect()
    assert not ingest_csv(spark, source, lake)
    assert sorted(read_lake(spark, lake).collect()) == sorted(before) and len(before) == 8
    write_all(source, [listing(9, "10")])
    assert ingest_csv(spark, source, lake)
    assert read_lake(spark, lake).count() == 9


def test_rows_of_an_unfinished_ingest_are_not_read(spark, tmp_path):
    source, lake = str(tmp_path / "feed.csv"), str(tmp_path / "lake")
    write_all(source, [listing(1, "10")])
    assert ingest_csv(spark, source, lake, ingest_id="a")
    left = read_lake(spark, lake).drop(*HOUR_COLUMNS).withColumn(ATTEMPT, F.lit("crashed"))
    append_to_lake(left, lake)
    assert read_lake(spark, lake).count() == 1


def test_further_columns_reach_the_processed_table(spark, tmp_path):
    source, lake, warehouse = (str(tmp_path / n) for n in ("feed.csv", "lake", "warehouse"))
    write_all(source, [listing(1, "10", brand="acme"), listing(2, "20", brand=None)])
    run(spark, source, lake, warehouse, now=datetime(2024, 1, 1))
    rows = spark.read.parquet(f"{warehouse}/runs/*/processed").collect()
    assert {(r.product_id, r.brand) for r in rows} == {(1, "acme"), (2, None)}


NUMBERS = ["1", "2", "1.5", "2.5", "99999999999999999999", "88888888888888888888", "9007199254740994.0", "9007199254740996.0"]


def test_every_number_is_a_product_of_its_own(spark, tmp_path):
    source, lake, warehouse = (str(tmp_path / n) for n in ("feed.csv", "lake", "warehouse"))
    feed = [{**listing(0, "10"), "product_id": p} for p in [*NUMBERS, "01.0", "x", "y", None]]
    write_all(source, feed)
    star = run(spark, source, lake, warehouse, now=datetime(2024, 1, 1))
    for table in (star.fact_product_listing, star.dim_product):
        assert table.count() == 9 and table.select("product_key").distinct().count() == 9
        assert {r.product_id for r in table.collect()} == {1, 2, 9007199254740994, 9007199254740996, None}
    assert reports.top_products(star).count() == 8


def test_the_run_published_last_counts(spark, tmp_path):
    source, lake, warehouse = (str(tmp_path / n) for n in ("feed.csv", "lake", "warehouse"))
    write_all(source, [listing(1, "10")])
    ingest_csv(spark, source, lake)
    load(spark, read_lake(spark, lake), warehouse, "z-first")
    write_all(source, [listing(2, "10")])
    ingest_csv(spark, source, lake)
    load(spark, read_lake(spark, lake), warehouse, "a-second")
    assert published_star(spark, warehouse).fact_product_listing.count() == 2


def test_the_median_comes_from_kept_counts(spark, tmp_path):
    """A later run reads the discounts of its own append only."""
    source, lake = str(tmp_path / "feed.csv"), str(tmp_path / "lake")
    seen = set()
    for n, discounts in enumerate([["10", "20", "n/a", "20"], ["", "x"], ["7.5", "90", "90", "1e1"]]):
        write_all(source, [listing(i, "10", discount=d) for i, d in enumerate(discounts)])
        ingest_csv(spark, source, lake, ingest_id=str(n))
        new, all_files = set(new_rows(spark, lake).inputFiles()), set(read_lake(spark, lake).inputFiles())
        assert new == all_files - seen
        seen = all_files
        assert update_summary(spark, lake) and not update_summary(spark, lake)
        assert merged_median(discount_counts(spark, lake)) == exact_median(read_lake(spark, lake), discount_value())
    counts = discount_counts(spark, lake)
    assert new_rows(spark, lake) is None and merged_median(counts) == 20.0
    newest = latest_versions(read_lake(spark, lake))
    with_counts = process(read_lake(spark, lake), newest=newest, discounts=counts)
    assert sorted(with_counts.collect(), key=str) == sorted(process(read_lake(spark, lake)).collect(), key=str)


def test_counts_merge_to_the_median_of_all_values(spark):
    rng = random.Random(2)
    for size in (1, 2, 501, 4000):
        values = [float(rng.randrange(rng.choice([3, 1000]))) for _ in range(size)]
        rows = spark.createDataFrame([(v, n) for v in values for n in (2, 1, 0)], "v double, n bigint")
        assert merged_median(rows, max_values=50) == median(values)


def test_an_hourly_run_over_a_landed_lake(spark, tmp_path):
    source, landed, marks = (str(tmp_path / name) for name in ("in", "lake", "marks"))

    def hour(i, rows):
        raw_rows(spark, rows).write.parquet(f"{source}/{i}")
        jobs.land(jobs.file_stream(spark, source, LAKE_SCHEMA), landed, f"{marks}/land").awaitTermination()
        star = run_landed(spark, landed, str(tmp_path / "latest"), f"{marks}/fold", str(tmp_path / "warehouse"))
        return {r.product_id: r.title for r in star.dim_product.collect()}

    def version(product, title):
        fields = {"title": title, "category": "Toys", "seller_name": "s", "currency": "INR"}
        return {"product_id": product, "final_price": "10", "initial_price": "20", "discount": "1", "rating": "4", "ratings_count": "3", **fields}

    assert hour(0, [version("1", "a"), version("2", "b")]) == {1: "a", 2: "b"}
    assert hour(1, [version("2", "c"), version("3", "d")]) == {1: "a", 2: "c", 3: "d"}
    expected = process(read_lake(spark, landed)).select("product_id", "title").collect()
    assert {r.product_id: r.title for r in expected} == {1: "a", 2: "c", 3: "d"}
