"""Column lists, table schemas and fixed domains."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

# Text read as a missing value, whether quoted or not.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

UNKNOWN_SELLER = "Unknown Seller"
NO_VALUE = "none"
UNKNOWN = "unknown"

PRICE_BUCKETS = ["budget", "mid_range", "premium", "luxury"]
RATING_TIERS = ["excellent", "good", "average", "poor"]

# ----------------------------------------------------------------------------

RAW_COLUMNS = [
    "product_id", "title", "category", "currency", "initial_price", "final_price",
    "discount", "rating", "ratings_count", "seller_name", "videos", "variations",
    "seller_information", "what_customers_said",
]

# Arrival order of a row: the newest version of a product has the greatest key.
ORDER_COLUMNS = ["_ingested_at", "_batch_id", "_row_id", "_source_file"]
# The attempt of a repeatable ingest that wrote a row.
ATTEMPT = "_attempt"
METADATA_COLUMNS = ORDER_COLUMNS + [ATTEMPT] + ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

LAKE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("_ingested_at", T.TimestampNTZType()),  # naive UTC
        T.StructField("_batch_id", T.LongType()),
        T.StructField("_row_id", T.LongType()),
    ]
)

NUMERIC_COLUMNS = ["rating", "ratings_count", "initial_price", "discount"]


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# `product_key` tells products apart: one text for each number, exact at any
# size. `product_id` is that number where it is a BIGINT.
PROCESSED_SCHEMA = _table(
    product_key=T.StringType(),
    product_id=T.LongType(),
    title=T.StringType(),
    category=T.StringType(),
    currency=T.StringType(),
    initial_price=T.DoubleType(),
    final_price=T.DoubleType(),
    discount=T.DoubleType(),
    rating=T.DoubleType(),
    ratings_count=T.DoubleType(),
    seller_name=T.StringType(),
    videos=T.StringType(),
    variations=T.StringType(),
    seller_information=T.StringType(),
    what_customers_said=T.DoubleType(),
    discount_amount=T.DoubleType(),
    is_discounted=T.BooleanType(),
    price_bucket=T.StringType(),
    ratings_tier=T.StringType(),
    has_seller=T.BooleanType(),
    has_variations=T.BooleanType(),
    category_slug=T.StringType(),
    title_word_count=T.IntegerType(),
    rating_x_count=T.DoubleType(),
    rating_clamped=T.BooleanType(),
)

DIM_CATEGORY_SCHEMA = _table(category_slug=T.StringType(), category_name=T.StringType())
DIM_SELLER_SCHEMA = _table(seller_name=T.StringType())
DIM_PRODUCT_SCHEMA = _table(
    product_key=T.StringType(),
    product_id=T.LongType(),
    title=T.StringType(),
    currency=T.StringType(),
    has_variations=T.BooleanType(),
)
FACT_SCHEMA = _table(
    product_key=T.StringType(),
    product_id=T.LongType(),
    category_slug=T.StringType(),
    seller_name=T.StringType(),
    initial_price=T.DoubleType(),
    final_price=T.DoubleType(),
    discount=T.DoubleType(),
    discount_amount=T.DoubleType(),
    is_discounted=T.BooleanType(),
    price_bucket=T.StringType(),
    rating=T.DoubleType(),
    ratings_count=T.DoubleType(),
    ratings_tier=T.StringType(),
    rating_x_count=T.DoubleType(),
    title_word_count=T.IntegerType(),
    has_seller=T.BooleanType(),
)
