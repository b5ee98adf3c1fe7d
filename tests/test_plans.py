"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as contract
from shelfwise import registry, staging
from shelfwise.plans import reports

TINY = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, TINY))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan


def report_plan(spark, report):
    return plan_of(report(staging.star(spark, TINY)))


def test_scans_read_needed_columns_only(spark):
    plan = report_plan(spark, reports.rating_distribution)
    assert "ReadSchema: struct<final_price:double,rating" in plan.replace("ratings_count:double,", "")
    assert "category_slug" not in plan and "seller_name" not in plan


def test_filters_reach_the_scan(spark):
    plan = report_plan(spark, reports.top_sellers)
    assert "Not(EqualTo(seller_name,Unknown Seller))" in plan


def test_top_k_does_not_sort_everything(spark):
    for report in (reports.top_sellers, reports.top_products, reports.revenue_by_category, reports.product_sample):
        assert "TakeOrderedAndProject" in report_plan(spark, report)


def test_the_limit_runs_below_the_product_join(spark):
    plan = report_plan(spark, reports.top_products)
    assert plan.index("BroadcastHashJoin") < plan.index("TakeOrderedAndProject")


def test_aggregates_fold_before_the_shuffle(spark):
    above, below = report_plan(spark, reports.category_performance).split("Exchange hashpartitioning", 1)
    assert "partial_sum" in below.split("FileScan")[0]


def test_dimensions_are_broadcast_by_size_only(spark, tmp_path):
    """Without room for a broadcast the same report shuffles instead."""
    star = staging.star(spark, TINY)
    expected = reports.category_performance(star).collect()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        report = reports.category_performance(star)
        assert "SortMergeJoin" in plan_of(report)
        assert report.collect() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_staged_tables_are_built_once_and_follow_their_source(spark, tmp_path):
    source = tmp_path / "tables"
    for name in staging.SOURCES:
        spark.read.parquet(f"{TINY}/{name}.parquet").write.parquet(f"{source}/{name}.parquet")
    first = staging.lake_path(spark, str(source))
    assert staging.lake_path(spark, str(source)) == first
    before = staging.lake(spark, str(source)).count()
    spark.read.parquet(f"{TINY}/lineitem.parquet").write.mode("append").parquet(f"{source}/lineitem.parquet")
    staging.refresh(spark, str(source))
    assert staging.lake(spark, str(source)).count() == 2 * before
