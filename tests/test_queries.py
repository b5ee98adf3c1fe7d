"""Every registered query against its SQL counterpart, and published figures."""

import pytest

import __spark_entry__ as contract
from shelfwise import registry
from shelfwise_oracle import ORACLE_SQL
from tests.compare import connect, difference

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tiny():
    return connect(TINY)


def test_every_query_has_a_counterpart():
    assert set(ORACLE_SQL) == set(registry.queries())
    assert registry.queries().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, tiny, name):
    got = contract.queries()[name](spark, TINY).toPandas()
    assert difference(got, tiny.execute(contract.oracle_sql()[name]).df()) is None
    assert len(got) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def one(spark, name):
    return contract.queries()[name](spark, SMALL).first().asDict()


def test_key_figures(spark):
    assert one(spark, "executive_overview") == {
        "total_skus": 2000,
        "avg_rating": 2.74,
        "avg_discount_pct": 32.6,
        "avg_selling_price": 3475.97,
        "total_revenue_potential": 6951934.88,
        "discounted_products": 1916,
        "pct_discounted": 95.8,
    }


def test_domain_figures(spark):
    def counts(name):
        return [r[1] for r in contract.queries()[name](spark, SMALL).collect()]

    assert counts("price_bucket_counts") == [328, 920, 466, 286]
    assert counts("rating_tier_counts") == [377, 140, 341, 1037, 105]
    bands = contract.queries()["discount_effectiveness"](spark, SMALL).collect()
    assert {r.discount_band: r.product_count for r in bands} == {
        "0%": 84, "1–9%": 178, "10–19%": 189, "20–29%": 184, "30–49%": 740, "50%+": 625,
    }
    assert [r.discount_band for r in bands] == sorted(r.discount_band for r in bands)
    quality = contract.queries()["listing_quality"](spark, SMALL).collect()
    assert {r.listing_richness: (r.products, r.with_known_seller) for r in quality} == {
        "sparse": (641, 463), "moderate": (672, 480), "rich": (687, 486),
    }


def test_relation_figures(spark):
    assert one(spark, "discount_rating_corr") == {"correlation": -0.024414}
    line = contract.queries()["discount_rating_trend"](spark, SMALL).collect()
    slope = (line[-1].rating - line[0].rating) / (line[-1].discount - line[0].discount)
    assert slope == pytest.approx(-0.002123, abs=1e-6)
    best = contract.queries()["top_products"](spark, SMALL).take(3)
    assert [(r.product_id, r.popularity_score) for r in best] == [
        (1316, 37.6053), (1685, 37.5698), (1922, 37.3145),
    ]
