"""Listing features and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schema import PRICE_BUCKETS, RATING_TIERS, UNKNOWN

# --- fixed values -----------------------------------------------------------

PRICE_UPPER_BOUNDS = [500, 2000, 5000]  # exclusive; above the last is the top bucket
TIER_LOWER_BOUNDS = [4.5, 4.0, 3.0]  # inclusive; below the last is the bottom tier

# (label, lowest, highest), both ends inclusive.
DISCOUNT_RANGES = [("10–19%", 10, 19), ("20–29%", 20, 29), ("30–49%", 30, 49)]

# (label, words below)
RICHNESS_BOUNDS = [("sparse", 5), ("moderate", 10)]

# ----------------------------------------------------------------------------


def price_bucket(price: Column) -> Column:
    bucket = F.when(price.isNull(), UNKNOWN)
    for label, bound in zip(PRICE_BUCKETS, PRICE_UPPER_BOUNDS):
        bucket = bucket.when(price < bound, label)
    return bucket.otherwise(PRICE_BUCKETS[-1])


def ratings_tier(rating: Column) -> Column:
    tier = F.when(rating.isNull(), UNKNOWN)
    for label, bound in zip(RATING_TIERS, TIER_LOWER_BOUNDS):
        tier = tier.when(rating >= bound, label)
    return tier.otherwise(RATING_TIERS[-1])


def discount_band(discount: Column) -> Column:
    """Band label of a percent.

    The ranges are meant for whole percents: a value between two of them
    (19.5) falls to the last band, as does NULL.
    """
    band = F.when(discount == 0, "0%").when(discount < 10, "1–9%")
    for label, low, high in DISCOUNT_RANGES:
        band = band.when(discount.between(low, high), label)
    return band.otherwise("50%+")


def listing_richness(words: Column) -> Column:
    """Completeness label of a title's word count; NULL counts as rich."""
    (sparse, few), (moderate, some) = RICHNESS_BOUNDS
    return F.when(words < few, sparse).when(words < some, moderate).otherwise("rich")


def non_negative(amount: Column) -> Column:
    """Negative amounts to 0, NULL stays NULL (`greatest` would give 0)."""
    return F.when(amount < 0, F.lit(0.0)).otherwise(amount)


def clamp(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high], NULL stays NULL."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def popularity(rating: Column, count: Column) -> Column:
    """Rating times log(1 + count), to four digits.

    The logarithm of a count of -1 is minus infinity, below that undefined.
    """
    at_minus_one = rating * F.lit(float("-inf"))
    return F.when(count > -1, F.round(rating * F.log1p(count), 4)).when(
        (count == -1) & ~F.isnan(at_minus_one), at_minus_one
    )


def rank_in(label: Column, domain: list[str]) -> Column:
    """1-based position of a label in a fixed domain, unlisted labels last."""
    rank = F.when(label == domain[0], 1)
    for position, known in enumerate(domain[1:], start=2):
        rank = rank.when(label == known, position)
    return rank.otherwise(len(domain) + 1)
