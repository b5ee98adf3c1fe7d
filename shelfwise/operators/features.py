"""The nine derived listing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import listing, text
from shelfwise.schema import NO_VALUE, UNKNOWN_SELLER


def add_features(cleaned: DataFrame) -> DataFrame:
    """Row-wise features of cleaned listings; ratings are not yet clamped."""
    final, rating = F.col("final_price"), F.col("rating")
    return cleaned.withColumns(
        {
            "discount_amount": listing.non_negative(F.col("initial_price") - final),
            "is_discounted": F.coalesce(F.col("discount") > 0, F.lit(False)),
            "price_bucket": listing.price_bucket(final),
            "ratings_tier": listing.ratings_tier(rating),
            "has_seller": F.col("seller_name") != UNKNOWN_SELLER,
            "has_variations": F.col("variations") != NO_VALUE,
            "category_slug": text.slug(F.col("category")),
            "title_word_count": text.word_count(F.col("title")),
            "rating_x_count": listing.popularity(rating, F.col("ratings_count")),
        }
    )
