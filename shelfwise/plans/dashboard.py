"""Datasets of the dashboard pages that no report covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.exact import exact_avg, percent, share_of_total
from shelfwise.operators import counts
from shelfwise.plans.warehouse import Star
from shelfwise.schema import PRICE_BUCKETS, UNKNOWN


def discount_split(star: Star) -> DataFrame:
    """Discounted and full-price listings with their shares."""
    return (
        star.fact_product_listing.groupBy("is_discounted")
        .agg(F.count("*").alias("products"))
        .withColumn("share_pct", share_of_total("products"))
        .orderBy("is_discounted")
    )


def price_scatter(star: Star) -> DataFrame:
    """Rating and price of every listing with its price bucket."""
    return star.fact_product_listing.select("product_id", "rating", "final_price", "price_bucket")


def price_histogram(star: Star, bins: int = 20) -> DataFrame:
    """Selling prices in equal-width bins."""
    return counts.histogram(star.fact_product_listing, "final_price", bins)


def category_bucket_matrix(star: Star) -> DataFrame:
    """Products per category and price bucket, a column per bucket."""
    cells = [
        F.count_if(F.col("price_bucket") == bucket).alias(bucket) for bucket in [*PRICE_BUCKETS, UNKNOWN]
    ]
    return star.fact_product_listing.groupBy("category_slug").agg(*cells).orderBy("category_slug")


def category_discount(star: Star) -> DataFrame:
    """Average discount per category."""
    return (
        star.fact_product_listing.groupBy("category_slug")
        .agg(exact_avg("discount", 1).alias("avg_discount_pct"))
        .orderBy("category_slug")
    )


def known_seller_pct(star: Star) -> DataFrame:
    """Percent of listings whose seller is known."""
    return star.fact_product_listing.agg(
        percent(F.count_if("has_seller"), F.count("*")).alias("known_seller_pct")
    )
