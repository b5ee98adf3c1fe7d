"""Business reports over the star schema.

Money, ratings and percents are summed exactly (`functions.exact`), so a report
does not change with the order in which partitions arrive. Every order by has a
unique tie-break and puts NULLs last.

Joins follow the aggregation wherever the measures allow: a dimension then
meets one row per key, and a category or seller that holds a third of all
listings has been folded before anything is shuffled. No side is broadcast by
hint; Spark does so by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import listing
from shelfwise.functions.exact import exact_avg, exact_sum, percent, share_of_total
from shelfwise.plans.warehouse import Star
from shelfwise.schema import PRICE_BUCKETS, RATING_TIERS, UNKNOWN_SELLER


def _top(df: DataFrame, k: int, measure: str, *tie_breaks: str) -> DataFrame:
    ties = [F.col(c).asc_nulls_last() for c in tie_breaks]
    return df.orderBy(F.col(measure).desc_nulls_last(), *ties).limit(k)


def executive_overview(star: Star) -> DataFrame:
    """Seven key figures of the whole catalogue.

    Distinct products are counted by themselves: beside the other measures,
    every one of their buffers would be shuffled by product.
    """
    skus = star.fact_product_listing.agg(F.count_distinct("product_key")).scalar()
    return star.fact_product_listing.agg(
        exact_avg("rating", 2).alias("avg_rating"),
        exact_avg("discount", 1).alias("avg_discount_pct"),
        exact_avg("final_price", 2).alias("avg_selling_price"),
        exact_sum("final_price", 2).alias("total_revenue_potential"),
        F.count_if("is_discounted").alias("discounted_products"),
        percent(F.count_if("is_discounted"), F.count("*")).alias("pct_discounted"),
    ).select(skus.alias("total_skus"), "*")


def category_performance(star: Star) -> DataFrame:
    """Volume, price, rating and discount per category.

    A category name determines its slug, so grouping by slug is grouping by name.
    """
    return (
        star.fact_product_listing.where("category_slug is not null")
        .groupBy("category_slug")
        .agg(
            F.count("product_key").alias("product_count"),
            exact_avg("rating", 2).alias("avg_rating"),
            exact_avg("final_price", 2).alias("avg_price"),
            exact_sum("final_price", 2).alias("total_revenue_potential"),
            exact_avg("discount", 1).alias("avg_discount_pct"),
            exact_avg("discount_amount", 2).alias("avg_discount_amount"),
        )
        .join(star.dim_category, "category_slug")
        .drop("category_slug")
        .orderBy(F.col("total_revenue_potential").desc_nulls_last(), "category_name")
        .select(
            "category_name",
            "product_count",
            "avg_rating",
            "avg_price",
            "total_revenue_potential",
            "avg_discount_pct",
            "avg_discount_amount",
        )
    )


def price_segmentation(star: Star) -> DataFrame:
    """Products per price bucket with their share of the catalogue."""
    return (
        star.fact_product_listing.groupBy("price_bucket")
        .agg(
            F.count("*").alias("product_count"),
            exact_avg("rating", 2).alias("avg_rating"),
            exact_avg("ratings_count", 0).alias("avg_review_count"),
            exact_avg("discount", 1).alias("avg_discount_pct"),
        )
        .withColumn("pct_of_catalog", share_of_total("product_count"))
        .orderBy(listing.rank_in(F.col("price_bucket"), PRICE_BUCKETS), "price_bucket")
        .select(
            "price_bucket",
            "product_count",
            "pct_of_catalog",
            "avg_rating",
            "avg_review_count",
            "avg_discount_pct",
        )
    )


def top_sellers(star: Star, k: int = 10) -> DataFrame:
    """Known sellers with the most listings."""
    sellers = (
        star.fact_product_listing.where(F.col("seller_name") != UNKNOWN_SELLER)
        .groupBy("seller_name")
        .agg(
            F.count("product_key").alias("products_listed"),
            exact_avg("rating", 2).alias("avg_product_rating"),
            exact_avg("final_price", 2).alias("avg_price"),
            exact_sum("discount_amount", 2).alias("total_discount_given"),
            exact_avg("discount", 1).alias("avg_discount_pct"),
        )
    )
    return _top(sellers.join(star.dim_seller, "seller_name"), k, "products_listed", "seller_name")


def rating_distribution(star: Star) -> DataFrame:
    """Products per rating tier with their share of the catalogue."""
    return (
        star.fact_product_listing.groupBy("ratings_tier")
        .agg(
            F.count("*").alias("product_count"),
            exact_avg("final_price", 2).alias("avg_price"),
            exact_avg("ratings_count", 0).alias("avg_reviews"),
        )
        .withColumn("pct_of_catalog", share_of_total("product_count"))
        .orderBy(listing.rank_in(F.col("ratings_tier"), RATING_TIERS), "ratings_tier")
        .select("ratings_tier", "product_count", "pct_of_catalog", "avg_price", "avg_reviews")
    )


def _most_popular(star: Star, k: int, *required: str) -> DataFrame:
    """The k best scored facts that have the given keys.

    Every non-null key of the fact has one dimension row (the four tables come
    from one processed table, and `quality_check` counts orphans), so an inner
    join keeps exactly these facts and the limit may run before it: the
    catalogue-sized product dimension meets k rows.
    """
    facts = star.fact_product_listing
    for key in required:
        facts = facts.where(F.col(key).isNotNull())
    return _top(facts, k, "rating_x_count", "product_id", "product_key")


def top_products(star: Star, k: int = 20) -> DataFrame:
    """Products with the highest popularity score, with title and category."""
    best = _most_popular(star, k, "product_key", "category_slug")
    return (
        best.join(star.dim_product.select("product_key", "title"), "product_key")
        .join(star.dim_category, "category_slug")
        .withColumnRenamed("rating_x_count", "popularity_score")
        .orderBy(F.col("popularity_score").desc_nulls_last(), F.col("product_id").asc_nulls_last(), "product_key")
        .select(
            "product_id",
            "title",
            "category_name",
            "rating",
            "ratings_count",
            "final_price",
            "discount",
            "popularity_score",
        )
    )


def _by_label(star: Star, label: Column, name: str, count: str, price: str, *extra: Column) -> DataFrame:
    return (
        star.fact_product_listing.groupBy(label.alias(name))
        .agg(
            F.count("*").alias(count),
            exact_avg("rating", 2).alias("avg_rating"),
            exact_avg("ratings_count", 0).alias("avg_reviews"),
            exact_avg("final_price", 2).alias(price),
            *extra,
        )
        .orderBy(name)
    )


def discount_effectiveness(star: Star) -> DataFrame:
    """Rating, reviews and price per discount band."""
    band = listing.discount_band(F.col("discount"))
    return _by_label(star, band, "discount_band", "product_count", "avg_final_price")


def listing_quality(star: Star) -> DataFrame:
    """Rating, reviews, price and known sellers per title completeness."""
    richness = listing.listing_richness(F.col("title_word_count"))
    known = F.count_if("has_seller").alias("with_known_seller")
    return _by_label(star, richness, "listing_richness", "products", "avg_price", known)


def revenue_by_category(star: Star, k: int = 10) -> DataFrame:
    """Categories with the most revenue; listings without category are one of them."""
    revenue = star.fact_product_listing.groupBy("category_slug").agg(
        F.count("*").alias("products"),
        exact_avg("rating", 2).alias("avg_rating"),
        exact_sum("final_price", 0).alias("revenue"),
    )
    return _top(revenue, k, "revenue", "category_slug")


def product_sample(star: Star, k: int = 20) -> DataFrame:
    """The first k listings by identifier, with title."""
    order = [F.col("product_id").asc_nulls_last(), F.col("product_key")]
    first = star.fact_product_listing.where("product_key is not null").orderBy(*order).limit(k)
    return (
        first.join(star.dim_product.select("product_key", "title"), "product_key")
        .orderBy(*order)
        .select("product_id", "title", "category_slug", "rating", "final_price", "price_bucket")
    )
