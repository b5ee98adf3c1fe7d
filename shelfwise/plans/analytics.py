"""The data behind the notebook's key figures and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfwise.functions.exact import exact_avg, exact_sum, share_of_total
from shelfwise.operators import counts
from shelfwise.operators.comoments import comoments
from shelfwise.plans.reports import _most_popular, _top
from shelfwise.plans.warehouse import Star
from shelfwise.schema import PRICE_BUCKETS, RATING_TIERS, UNKNOWN

_TITLE_CHARACTERS = 35


def kpi_snapshot(star: Star) -> DataFrame:
    """Eight key figures. `known_sellers` counts listings, not sellers."""
    return star.fact_product_listing.agg(
        F.count("*").alias("total_products"),
        exact_avg("rating", 2).alias("avg_rating"),
        exact_avg("discount", 1).alias("avg_discount"),
        exact_avg("final_price", 0).alias("avg_selling_price"),
        exact_sum("final_price", 0).alias("revenue_potential"),
        F.count_if("is_discounted").alias("discounted_products"),
        F.count_if("has_seller").alias("known_sellers"),
        F.count_distinct("category_slug").alias("categories"),
    )


def kpi_labels(star: Star) -> DataFrame:
    """The key figures as display texts, one row each."""

    def grouped(name: str) -> Column:
        return F.format_number(F.col(name), 0)

    def amount(name: str) -> Column:
        return F.concat(F.lit("INR "), grouped(name))

    labels = [
        ("Total Products", grouped("total_products")),
        ("Avg Rating", F.format_string("%.2f / 5", F.col("avg_rating"))),
        ("Avg Discount", F.format_string("%.1f%%", F.col("avg_discount"))),
        ("Avg Selling Price", amount("avg_selling_price")),
        ("Revenue Potential", amount("revenue_potential")),
        ("Discounted Products", grouped("discounted_products")),
        ("Known Sellers", grouped("known_sellers")),
        ("Categories", F.col("categories").cast("string")),
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("kpi"), v.alias("label")) for k, v in labels])
    return kpi_snapshot(star).select(F.inline(rows))


def top_categories(star: Star, k: int = 10) -> DataFrame:
    """Categories with the most revenue; listings without category are left out."""
    revenue = (
        star.fact_product_listing.where("category_slug is not null")
        .groupBy(F.col("category_slug").alias("category"))
        .agg(F.coalesce(exact_sum("final_price", 2), F.lit(0.0)).alias("revenue"))
    )
    return _top(revenue, k, "revenue", "category")


def price_bucket_counts(star: Star) -> DataFrame:
    """Products per listed price bucket, NULL for a bucket without products."""
    return counts.domain_counts(star.fact_product_listing, "price_bucket", PRICE_BUCKETS)


def price_bucket_share(star: Star) -> DataFrame:
    """Percent of each listed price bucket in all listed buckets."""
    return price_bucket_counts(star).withColumn("share_pct", share_of_total("products"))


def rating_tier_counts(star: Star) -> DataFrame:
    """Products per rating tier, tiers without products left out."""
    tiers = [*RATING_TIERS, UNKNOWN]
    return counts.domain_counts(star.fact_product_listing, "ratings_tier", tiers, keep_absent=False)


def rating_histogram(star: Star, bins: int = 20) -> DataFrame:
    """Ratings in equal-width bins, with the mean rating on every row."""
    mean = star.fact_product_listing.agg(exact_avg("rating", 6)).scalar()
    return counts.histogram(star.fact_product_listing, "rating", bins).withColumn("mean_rating", mean)


def discount_rating_scatter(star: Star) -> DataFrame:
    """Discount, rating and price of every listing."""
    return star.fact_product_listing.select("discount", "rating", "final_price")


def discount_rating_trend(star: Star, points: int = 100) -> DataFrame:
    """Least-squares line of rating on discount at evenly spaced discounts."""
    fact = star.fact_product_listing
    slope = F.col("xy") / F.nullif("xx", F.lit(0.0))
    line = comoments(fact, "discount", "rating").select(
        slope.alias("slope"), (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept")
    )
    ends = fact.agg(F.min("discount").alias("lo"), F.max("discount").alias("hi"))
    fit = ends.select(F.struct(line.select(F.struct("*")).scalar().alias("line"), "lo", "hi")).scalar()
    position = F.col("id")
    step = (F.col("fit.hi") - F.col("fit.lo")) / (points - 1)
    x = F.when(position == points - 1, F.col("fit.hi")).otherwise(position * step + F.col("fit.lo"))
    return (
        fact.sparkSession.range(0, points, 1, 1)
        .withColumn("fit", fit)
        .withColumn("x", x)
        .select(
            (position + 1).cast("int").alias("point"),
            F.round("x", 6).alias("discount"),
            F.round(F.col("fit.line.slope") * F.col("x") + F.col("fit.line.intercept"), 6).alias("rating"),
        )
        .orderBy("point")
    )


def discount_rating_corr(star: Star) -> DataFrame:
    """Pearson correlation of discount and rating; NULL if one is constant."""
    sums = comoments(star.fact_product_listing, "discount", "rating")
    spread = F.sqrt("xx") * F.sqrt("yy")
    return sums.select(F.round(F.col("xy") / F.nullif(spread, F.lit(0.0)), 6).alias("correlation"))


def top_products(star: Star, k: int = 10) -> DataFrame:
    """The most popular products with a shortened title."""
    best = _most_popular(star, k, "product_key")
    short = F.concat(F.substring("title", 1, _TITLE_CHARACTERS), F.lit("..."))
    return (
        best.join(star.dim_product.select("product_key", "title"), "product_key")
        .withColumn("short_title", short)
        .orderBy(F.col("rating_x_count").desc_nulls_last(), F.col("product_id").asc_nulls_last(), "product_key")
        .select(
            "title",
            "category_slug",
            "rating",
            "ratings_count",
            "final_price",
            "rating_x_count",
            "short_title",
        )
    )


def category_heatmap(star: Star, k: int = 15, least_products: int = 5) -> DataFrame:
    """Best rated categories of some size, each measure also scaled to 0..1.

    The scaling sees the k rows only, so its window is as small.
    """
    measures = ["avg_rating", "avg_discount", "avg_price"]
    categories = (
        star.fact_product_listing.groupBy("category_slug")
        .agg(
            exact_avg("rating", 2).alias("avg_rating"),
            exact_avg("discount", 1).alias("avg_discount"),
            exact_avg("final_price", 0).alias("avg_price"),
            F.count("*").alias("products"),
        )
        .where(F.col("products") >= least_products)
    )
    best = _top(categories, k, "avg_rating", "category_slug")

    def scaled(name: str) -> Column:
        low = F.min(name).over(Window.partitionBy())
        high = F.max(name).over(Window.partitionBy())
        return ((F.col(name) - low) / F.nullif(high - low, F.lit(0.0))).alias(f"{name}_norm")

    return best.select("category_slug", *measures, "products", *[scaled(m) for m in measures]).orderBy(
        F.col("avg_rating").desc_nulls_last(), F.col("category_slug").asc_nulls_last()
    )
