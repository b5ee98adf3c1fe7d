"""Reports, analytics and the quality gate on small hand-made tables."""

import numpy as np
import pytest

from shelfwise.plans import analytics, dashboard, reports
from shelfwise.plans.quality import QualityError, quality_check, require_quality
from shelfwise.plans.transform import process
from shelfwise.plans.warehouse import build_star
from tests.test_operators import raw_rows


def star_of(spark, rows, tmp_path):
    path = str(tmp_path / "processed")
    process(raw_rows(spark, rows)).write.parquet(path)
    return build_star(spark.read.parquet(path))


@pytest.fixture()
def dirty(spark, tmp_path):
    """Products without category, price, rating or identifier."""
    rows = [
        {"product_id": "1", "category": " B  c ", "final_price": "100", "rating": "4", "ratings_count": "9", "title": "x"},
        {"product_id": "2", "category": "b C", "final_price": "700", "rating": "2", "ratings_count": "0", "seller_name": "s"},
        {"product_id": "3", "category": None, "final_price": "9000", "rating": "5", "ratings_count": "99"},
        {"product_id": None, "category": "d", "final_price": None, "rating": "1", "ratings_count": "999"},
        {"product_id": "4", "category": "e", "final_price": None, "rating": None},
    ]
    return star_of(spark, rows, tmp_path)


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_dim_category_names(dirty):
    assert set(rows_of(dirty.dim_category, "category_slug", "category_name")) == {
        ("b-c", " B  c "), (None, None), ("d", "d"), ("e", "e"),
    }


def test_rows_without_category(dirty):
    assert rows_of(reports.category_performance(dirty), "category_name", "product_count") == [
        (" B  c ", 2), ("d", 0), ("e", 1),
    ]
    assert rows_of(reports.revenue_by_category(dirty), "category_slug", "revenue") == [
        (None, 9000.0), ("b-c", 800.0), ("d", None), ("e", None),
    ]
    assert rows_of(analytics.top_categories(dirty), "category", "revenue") == [
        ("b-c", 800.0), ("d", 0.0), ("e", 0.0),
    ]


def test_top_products_drop_rows_without_keys(dirty):
    assert rows_of(reports.top_products(dirty), "product_id") == [(1,), (2,), (4,)]
    assert rows_of(analytics.top_products(dirty), "category_slug") == [(None,), ("b-c",), ("b-c",), ("e",)]


def test_unknown_price_is_outside_the_domain(dirty):
    assert rows_of(analytics.price_bucket_counts(dirty), "price_bucket", "products") == [
        ("budget", 1), ("mid_range", 1), ("premium", None), ("luxury", 1),
    ]
    assert rows_of(analytics.price_bucket_share(dirty), "share_pct") == [(33.3,), (33.3,), (None,), (33.3,)]
    assert rows_of(reports.price_segmentation(dirty), "price_bucket", "pct_of_catalog") == [
        ("budget", 20.0), ("mid_range", 20.0), ("luxury", 20.0), ("unknown", 40.0),
    ]
    matrix = rows_of(dashboard.category_bucket_matrix(dirty), "category_slug", "budget", "unknown")
    assert matrix == [(None, 0, 0), ("b-c", 1, 0), ("d", 0, 1), ("e", 0, 1)]


def test_known_sellers_only(dirty):
    assert rows_of(reports.top_sellers(dirty), "seller_name", "products_listed") == [("s", 1)]
    assert rows_of(dashboard.known_seller_pct(dirty), "known_seller_pct") == [(20.0,)]


def test_short_titles(dirty):
    titles = dict(rows_of(analytics.top_products(dirty), "title", "short_title"))
    assert titles == {"x": "x...", None: None}


def test_shares_sum_to_hundred(dirty):
    for report in (reports.price_segmentation, reports.rating_distribution):
        assert sum(r.pct_of_catalog for r in report(dirty).collect()) == pytest.approx(100, abs=0.3)


def relation(spark, tmp_path, pairs):
    rows = [{"product_id": str(i), "discount": str(d), "rating": str(r)} for i, (d, r) in enumerate(pairs)]
    return star_of(spark, rows, tmp_path)


def test_trend_and_correlation(spark, tmp_path):
    rng = np.random.default_rng(1)
    pairs = np.round(rng.random((300, 2)) * [60, 5], 2)
    star = relation(spark, tmp_path, pairs.tolist())
    line = analytics.discount_rating_trend(star).collect()
    x = np.linspace(pairs[:, 0].min(), pairs[:, 0].max(), 100)
    fitted = np.poly1d(np.polyfit(pairs[:, 0], pairs[:, 1], 1))(x)
    assert [r.discount for r in line] == pytest.approx(x.tolist(), abs=1e-6)
    assert [r.rating for r in line] == pytest.approx(fitted.tolist(), abs=1e-6)
    corr = analytics.discount_rating_corr(star).first().correlation
    assert corr == pytest.approx(np.corrcoef(pairs.T)[0, 1], abs=1e-6)


def test_constant_column_has_no_correlation(spark, tmp_path):
    star = relation(spark, tmp_path, [(10, 4), (10, 3)])
    assert analytics.discount_rating_corr(star).first().correlation is None
    assert {r.rating for r in analytics.discount_rating_trend(star).collect()} == {None}
    assert {r.avg_rating_norm for r in analytics.category_heatmap(star, least_products=1).collect()} == {None}


def test_empty_star(spark, tmp_path):
    star = star_of(spark, [], tmp_path)
    assert reports.executive_overview(star).first().asDict()["total_skus"] == 0
    assert reports.executive_overview(star).first().pct_discounted is None
    with pytest.raises(QualityError, match="dim_category.row_count: 0"):
        require_quality(quality_check(star))


def test_gate_finds_repeated_keys_and_orphans(dirty):
    checks = {(r.table_name, r.check_name): r for r in quality_check(dirty).collect()}
    assert checks["dim_product", "missing_keys"].observed == 1
    require_quality(quality_check(dirty))
    twice = type(dirty)(
        dirty.dim_category.where("category_slug = 'b-c'"),
        dirty.dim_seller,
        dirty.dim_product.union(dirty.dim_product),
        dirty.fact_product_listing,
    )
    with pytest.raises(QualityError) as error:
        require_quality(quality_check(twice))
    assert "dim_product.repeated_keys: 5" in str(error.value)
    assert "orphans_of_dim_category: 2" in str(error.value)


def test_sql_over_registered_tables(spark, dirty):
    dirty.register()
    got = spark.sql("select count(*) filter (where has_seller) n from fact_product_listing join dim_seller using (seller_name)")
    assert got.first().n == 1
