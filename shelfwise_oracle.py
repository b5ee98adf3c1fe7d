"""DuckDB statements that state the expected result of each registered query.

Every statement starts from the given tables and was written from the meaning
of the query, not from its Spark plan.
"""

from __future__ import annotations

# ------------------------------------------------------------------ the feed

FEED = r"""
feed AS (
  SELECT
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE p_size % 3
      WHEN 0 THEN p_name
      WHEN 1 THEN p_name || ' ' || p_brand || ' ' || p_type || ' size ' || p_size
      ELSE p_name || ' ' || p_brand || ' ' || p_type || ' size ' || p_size
           || ' sold by ' || s_name || ' new sealed' END AS title,
    '  ' || CASE WHEN l_linenumber % 2 = 0 THEN upper(p_type) ELSE lower(p_type) END
      || '   ' || p_brand || ' ' AS category,
    'INR' AS currency,
    (ic // 100) || '.' || lpad(CAST(ic % 100 AS VARCHAR), 2, '0') AS initial_price,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL
         WHEN l_orderkey % 17 = 0 THEN 'Price on request'
         WHEN fc >= 100000 THEN '₹' || (fc // 100000) || ','
              || lpad(CAST(fc // 100 % 1000 AS VARCHAR), 3, '0') || '.' || lpad(CAST(fc % 100 AS VARCHAR), 2, '0')
         ELSE '₹' || (fc // 100) || '.' || lpad(CAST(fc % 100 AS VARCHAR), 2, '0') END AS final_price,
    CASE WHEN l_orderkey % 11 <> 0
         THEN CAST(CAST(l_discount * 650 AS DECIMAL(6,2)) AS VARCHAR) END AS discount,
    CASE WHEN l_orderkey % 19 <> 0
         THEN CAST(CAST(l_quantity * 0.11 AS DECIMAL(4,2)) AS VARCHAR) END AS rating,
    CASE WHEN l_orderkey % 23 = 0 THEN 'n/a' ELSE CAST(l_orderkey % 997 AS VARCHAR) END AS ratings_count,
    CASE WHEN l_suppkey % 10 NOT IN (3, 7, 9) THEN s_name END AS seller_name,
    CAST(NULL AS VARCHAR) AS videos,
    CASE WHEN l_linestatus <> 'F' THEN 'S,M,L' END AS variations,
    CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS seller_information,
    CASE WHEN l_returnflag = 'R' THEN 'mixed'
         ELSE CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END AS what_customers_said,
    l_shipdate AS _ingested_at,
    l_orderkey AS _batch_id,
    CAST(l_linenumber AS BIGINT) AS _row_id
  FROM (SELECT *, CAST(floor(ic * (1 - l_discount * 6.5)) AS BIGINT) AS fc
        FROM (SELECT *, CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS ic FROM lineitem)) l
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

NUMERIC = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def _number(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, {NUMERIC}) THEN TRY_CAST(trim({column}) AS DOUBLE) END"


TYPED = f"""
typed AS (
  SELECT * REPLACE (
    CAST({_number('product_id')} AS BIGINT) AS product_id,
    {_number('rating')} AS rating,
    {_number('ratings_count')} AS ratings_count,
    {_number('initial_price')} AS initial_price,
    {_number('discount')} AS discount,
    coalesce({_number('what_customers_said')}, 0.0) AS what_customers_said,
    coalesce(TRY_CAST(regexp_replace(final_price, '[^0-9.]', '', 'g') AS DOUBLE),
             {_number('initial_price')}) AS final_price,
    coalesce(seller_name, 'Unknown Seller') AS seller_name,
    coalesce(videos, 'none') AS videos,
    coalesce(variations, 'none') AS variations,
    coalesce(seller_information, 'unknown') AS seller_information)
  FROM feed
),
middle AS (SELECT median(discount) AS fill_value FROM typed),
filled AS (
  SELECT * REPLACE (coalesce(discount, fill_value) AS discount) FROM typed, middle
)"""

FEATURED = r"""
featured AS (
  SELECT * EXCLUDE (fill_value),
    CASE WHEN initial_price < final_price THEN 0.0 ELSE initial_price - final_price END AS discount_amount,
    coalesce(discount > 0, false) AS is_discounted,
    CASE WHEN final_price IS NULL THEN 'unknown' WHEN final_price < 500 THEN 'budget'
         WHEN final_price < 2000 THEN 'mid_range' WHEN final_price < 5000 THEN 'premium'
         ELSE 'luxury' END AS price_bucket,
    CASE WHEN rating IS NULL THEN 'unknown' WHEN rating >= 4.5 THEN 'excellent'
         WHEN rating >= 4.0 THEN 'good' WHEN rating >= 3.0 THEN 'average' ELSE 'poor' END AS ratings_tier,
    seller_name <> 'Unknown Seller' AS has_seller,
    variations <> 'none' AS has_variations,
    regexp_replace(trim(lower(category)), '\s+', '-', 'g') AS category_slug,
    CAST(len(regexp_extract_all(title, '\S+')) AS INTEGER) AS title_word_count,
    round(rating * ln(1 + ratings_count), 4) AS rating_x_count
  FROM filled
)"""

LATEST = """
latest AS (
  SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY product_id
                             ORDER BY _ingested_at DESC, _batch_id DESC, _row_id DESC) = 1
)"""

CLAMP = "CASE WHEN rating < 0 THEN 0.0 WHEN rating > 5 THEN 5.0 ELSE rating END"

PROCESSED = f"""
processed AS (
  SELECT CAST(product_id AS VARCHAR) AS product_key, * EXCLUDE (_ingested_at, _batch_id, _row_id) REPLACE ({CLAMP} AS rating),
    coalesce(rating < 0 OR rating > 5, false) AS rating_clamped FROM latest
)"""

CATEGORY = """
category AS (
  SELECT category_slug, arg_min(category, product_id) AS category_name FROM processed GROUP BY 1
)"""


def _with(*parts: str, select: str) -> str:
    joint = "" if select.strip().startswith(",") else "\n"
    return f"WITH {','.join(parts)}{joint}{select.strip()}"


def _raw(select: str) -> str:
    return _with(FEED, select=select)


def _typed(select: str) -> str:
    return _with(FEED, TYPED, select=select)


def _star(select: str) -> str:
    return _with(
        FEED, TYPED, FEATURED, LATEST.format(source="featured"), PROCESSED, CATEGORY, select=select
    )


# -------------------------------------------- exact sums, averages, shares


def _units(column: str) -> str:
    """The sum of the values' decimal notations, in units of 10^-15."""
    total = f"SUM(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,15)))"
    return f"CAST(replace(CAST({total} AS VARCHAR), '.', '') AS HUGEINT)"


def _avg(column: str, digits: int) -> str:
    """Average of a non-negative column, rounded half up in whole numbers."""
    q = 10 ** (15 - digits)
    total, n = _units(column), f"COUNT({column})"
    return f"CASE WHEN {n} > 0 THEN CAST((2 * {total} + {q} * {n}) // (2 * {q} * {n}) AS DOUBLE) / {10**digits} END"


def _sum(column: str, digits: int) -> str:
    q = 10 ** (15 - digits)
    return f"CAST((2 * {_units(column)} + {q}) // (2 * {q}) AS DOUBLE) / {10**digits}"


def _share(part: str, whole: str) -> str:
    """Percent to one digit, rounded half up in whole numbers."""
    return f"CAST((2000 * CAST({part} AS BIGINT) + CAST({whole} AS BIGINT)) // (2 * CAST({whole} AS BIGINT)) AS DOUBLE) / 10"


DISCOUNTED = "COUNT(*) FILTER (WHERE is_discounted)"
KNOWN = "COUNT(*) FILTER (WHERE has_seller)"
TOTAL = "SUM(COUNT(*)) OVER ()"

FACT_COLUMNS = """product_key, product_id, category_slug, seller_name, initial_price, final_price, discount,
  discount_amount, is_discounted, price_bucket, rating, ratings_count, ratings_tier,
  rating_x_count, title_word_count, has_seller"""


def _by_label(label: str, name: str, count: str, price: str, extra: str = "") -> str:
    return _star(f"""
SELECT {label} AS {name}, COUNT(*) AS {count}, {_avg('rating', 2)} AS avg_rating,
  {_avg('ratings_count', 0)} AS avg_reviews, {_avg('final_price', 2)} AS {price}{extra}
FROM processed GROUP BY 1 ORDER BY 1""")


def _histogram(column: str, extra: str = "") -> str:
    """Twenty bins; a bin holds its lower edge, the last one its upper edge too."""
    return _star(f"""
, span AS (
  SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
  FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM processed)),
bins AS (
  SELECT i + 1 AS bin, i * ((hi - lo) / 20) + lo AS lower,
    CASE WHEN i = 19 THEN hi ELSE (i + 1) * ((hi - lo) / 20) + lo END AS upper
  FROM span, range(20) t(i))
SELECT CAST(bin AS INTEGER) AS bin, lower, upper,
  (SELECT COUNT(*) FROM processed
   WHERE {column} >= lower AND ({column} < upper OR (bin = 20 AND {column} <= upper))) AS count{extra}
FROM bins ORDER BY bin""")


ORACLE_SQL = {
    # ------------------------------------------------ sources and ingestion
    "src_csv_na_normalize": _raw("""
SELECT CAST(_batch_id AS VARCHAR) AS _batch_id, CAST(_row_id AS VARCHAR) AS _row_id, product_id,
  title || chr(10) || '"' || currency || '", new' AS title,
  CASE WHEN ratings_count <> 'n/a' THEN ratings_count END AS ratings_count,
  CASE _batch_id % 21 WHEN 19 THEN ' NA ' WHEN 20 THEN 'clip.mp4' END AS videos,
  variations
FROM feed"""),
    "src_union_by_name": _raw("""
SELECT product_id, title, seller_name, rating, CAST(NULL AS VARCHAR) AS brand FROM feed
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), p_name, NULL, NULL, p_brand FROM part"""),
    "ingest_partition_counts": _raw("""
SELECT CAST(year(_ingested_at) AS INTEGER) AS ingest_year, CAST(month(_ingested_at) AS INTEGER) AS ingest_month,
  CAST(day(_ingested_at) AS INTEGER) AS ingest_day, CAST(hour(_ingested_at) AS INTEGER) AS ingest_hour,
  COUNT(*) AS rows, COUNT(DISTINCT _batch_id) AS batches
FROM feed GROUP BY 1, 2, 3, 4 ORDER BY 1, 2, 3, 4"""),
    "lake_since": _raw("""
SELECT CAST(year(_ingested_at) AS INTEGER) AS ingest_year, CAST(month(_ingested_at) AS INTEGER) AS ingest_month,
  1 AS ingest_day, 0 AS ingest_hour, COUNT(*) AS rows, COUNT(DISTINCT _batch_id) AS batches
FROM feed WHERE _ingested_at >= TIMESTAMP '1996-05-01' GROUP BY 1, 2 ORDER BY 1, 2"""),
    "star_sql": _star("""
SELECT category_name, COUNT(DISTINCT seller_name) AS sellers, COUNT(title) AS titles,
  COUNT(*) FILTER (WHERE has_variations) AS with_variations
FROM processed JOIN category USING (category_slug) GROUP BY 1"""),
    "micro_batch_assign": """
SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS _row_id,
  (row_number() OVER (ORDER BY event_id) - 1) // 50 AS _batch_id
FROM events""",
    "lake_discount_median": _typed("SELECT fill_value FROM middle"),
    "numbered_csv": """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, props,
  row_number() OVER (ORDER BY event_id) - 1 AS _row_id, (row_number() OVER (ORDER BY event_id) - 1) // 50 AS _batch_id
FROM events""",
    "foreign_lake": _raw("""
, foreign_rows AS (SELECT *, year(_ingested_at) % 4 AS kind FROM feed)
SELECT product_id, title, CASE WHEN kind = 2 THEN CAST(CAST(rating AS DOUBLE) AS VARCHAR) ELSE rating END AS rating, videos,
  CASE WHEN kind <> 2 THEN variations END AS variations, CASE WHEN kind = 1 THEN 'b' || currency END AS brand,
  CASE WHEN kind = 2 THEN TIMESTAMP '2024-01-02 02:00:00' ELSE CAST(date_trunc('month', _ingested_at) AS TIMESTAMP) END AS _ingested_at,
  _batch_id, CAST(CASE WHEN kind = 2 THEN 2 ELSE 0 END AS INTEGER) AS ingest_hour
FROM foreign_rows"""),
    "json_roundtrip": _raw("SELECT * FROM feed"),
    "stream_replay": """
SELECT event_id, user_id, event_type, value, props, row_number() OVER (ORDER BY event_id) - 1 AS _row_id,
  (row_number() OVER (ORDER BY event_id) - 1) // 50 AS _batch_id
FROM events""",
    "stream_dedup_latest": _with(
        FEED,
        LATEST.format(source="feed"),
        select="SELECT product_id AS product_key, * REPLACE (CAST(product_id AS BIGINT) AS product_id) FROM latest",
    ),
    # ------------------------------------------------------- cleaning steps
    "enforce_schema": _raw(f"""
SELECT * EXCLUDE (_ingested_at, _batch_id, _row_id) REPLACE (
  CAST({_number('product_id')} AS BIGINT) AS product_id, {_number('rating')} AS rating,
  {_number('ratings_count')} AS ratings_count, {_number('initial_price')} AS initial_price,
  {_number('discount')} AS discount)
FROM feed"""),
    "clean_prices": _typed("SELECT product_id, initial_price, final_price, _batch_id, _row_id FROM typed"),
    "fill_missing": _typed("""
SELECT product_id, seller_name, videos, variations, seller_information, what_customers_said, _batch_id, _row_id
FROM typed"""),
    "fill_discount_median": _typed("SELECT product_id, discount, _batch_id, _row_id, fill_value FROM filled"),
    "feature_engineering": _with(
        FEED,
        TYPED,
        FEATURED,
        select="""
SELECT product_id, _batch_id, _row_id, discount_amount, is_discounted, price_bucket, ratings_tier,
  has_seller, has_variations, category_slug, title_word_count, rating_x_count
FROM featured""",
    ),
    "validate_clamp": _typed(f"SELECT product_id, {CLAMP} AS rating, _batch_id, _row_id FROM typed"),
    "sql_functions": _with(
        FEED,
        f"""
priced AS (
  SELECT _batch_id, _row_id, TRY_CAST(regexp_replace(final_price, '[^0-9.]', '', 'g') AS DOUBLE) AS price,
    {_number('rating')} AS r
  FROM feed
)""",
        select="""
SELECT _batch_id, _row_id, price,
  CASE WHEN price IS NULL THEN 'unknown' WHEN price < 500 THEN 'budget' WHEN price < 2000 THEN 'mid_range'
       WHEN price < 5000 THEN 'premium' ELSE 'luxury' END AS price_bucket,
  CASE WHEN r IS NULL THEN 'unknown' WHEN r >= 4.5 THEN 'excellent' WHEN r >= 4.0 THEN 'good'
       WHEN r >= 3.0 THEN 'average' ELSE 'poor' END AS ratings_tier
FROM priced""",
    ),
    "dedup_number_forms": _raw("""
, forms AS (
  SELECT *, _batch_id % 14 AS form, rtrim(product_id, '0') AS short, len(product_id) - len(rtrim(product_id, '0')) AS zeros
  FROM feed
), keyed AS (
  SELECT *, CASE WHEN form <= 4 THEN product_id
      WHEN form <= 6 THEN ltrim(product_id || '5', '0') || 'e-1'
      WHEN product_id = '0' AND form <= 10 THEN '0'
      WHEN form = 7 THEN short || 'e' || (40 + zeros)
      WHEN form = 8 THEN '-' || product_id
      WHEN form = 9 THEN short || 'e' || (9999999999 + zeros)
      WHEN form = 10 THEN short || 'e' || (10000000000 + zeros)
      WHEN form = 12 THEN ltrim(product_id || repeat('0', 20) || '25', '0') || 'e-2'
      WHEN form = 13 THEN 'inf' END AS product_key
  FROM forms
)
SELECT product_key, CAST(product_id AS BIGINT) AS product_id, title, _batch_id, _row_id FROM (
  SELECT * REPLACE (CASE WHEN form IN (0, 1, 2, 3, 4, 8) OR product_key = '0' THEN product_key END AS product_id) FROM keyed
  QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY _ingested_at DESC, _batch_id DESC, _row_id DESC) = 1
)"""),
    "dedup_latest": _with(
        FEED,
        LATEST.format(source="feed"),
        select="SELECT product_id AS product_key, * REPLACE (CAST(product_id AS BIGINT) AS product_id) FROM latest",
    ),
    "step_counters": _with(
        FEED,
        TYPED,
        LATEST.format(source="typed"),
        select="""
SELECT (SELECT COUNT(*) FROM feed) AS raw_rows,
  (SELECT COUNT(*) FROM feed) - (SELECT COUNT(*) FROM latest) AS duplicates_removed,
  (SELECT COUNT(*) FROM latest WHERE rating < 0 OR rating > 5) AS ratings_clamped,
  (SELECT COUNT(*) FROM latest) AS output_rows""",
    ),
    "processed_listing": _star("SELECT * FROM processed"),
    # ---------------------------------------------------------- star schema
    "dim_category": _star("SELECT * FROM category"),
    "dim_seller": _star("SELECT DISTINCT seller_name FROM processed"),
    "dim_product": _star("SELECT product_key, product_id, title, currency, has_variations FROM processed"),
    "fact_product_listing": _star(f"SELECT {FACT_COLUMNS} FROM processed"),
    # -------------------------------------------------------------- reports
    "executive_overview": _star(f"""
SELECT COUNT(DISTINCT product_id) AS total_skus, {_avg('rating', 2)} AS avg_rating,
  {_avg('discount', 1)} AS avg_discount_pct, {_avg('final_price', 2)} AS avg_selling_price,
  {_sum('final_price', 2)} AS total_revenue_potential, {DISCOUNTED} AS discounted_products,
  {_share(DISCOUNTED, 'COUNT(*)')} AS pct_discounted
FROM processed"""),
    "category_performance": _star(f"""
SELECT category_name, COUNT(product_id) AS product_count, {_avg('rating', 2)} AS avg_rating,
  {_avg('final_price', 2)} AS avg_price, {_sum('final_price', 2)} AS total_revenue_potential,
  {_avg('discount', 1)} AS avg_discount_pct, {_avg('discount_amount', 2)} AS avg_discount_amount
FROM processed JOIN category USING (category_slug)
GROUP BY category_name ORDER BY total_revenue_potential DESC, category_name"""),
    "price_segmentation": _star(f"""
SELECT price_bucket, COUNT(*) AS product_count, {_share('COUNT(*)', TOTAL)} AS pct_of_catalog,
  {_avg('rating', 2)} AS avg_rating, {_avg('ratings_count', 0)} AS avg_review_count,
  {_avg('discount', 1)} AS avg_discount_pct
FROM processed GROUP BY price_bucket"""),
    "top_sellers": _star(f"""
SELECT seller_name, COUNT(product_id) AS products_listed, {_avg('rating', 2)} AS avg_product_rating,
  {_avg('final_price', 2)} AS avg_price, {_sum('discount_amount', 2)} AS total_discount_given,
  {_avg('discount', 1)} AS avg_discount_pct
FROM processed WHERE seller_name <> 'Unknown Seller'
GROUP BY seller_name ORDER BY products_listed DESC, seller_name LIMIT 10"""),
    "rating_distribution": _star(f"""
SELECT ratings_tier, COUNT(*) AS product_count, {_share('COUNT(*)', TOTAL)} AS pct_of_catalog,
  {_avg('final_price', 2)} AS avg_price, {_avg('ratings_count', 0)} AS avg_reviews
FROM processed GROUP BY ratings_tier"""),
    "top_products": _star("""
SELECT product_id, title, category_name, rating, ratings_count, final_price, discount,
  rating_x_count AS popularity_score
FROM processed JOIN category USING (category_slug)
ORDER BY rating_x_count DESC NULLS LAST, product_id LIMIT 20"""),
    "discount_effectiveness": _by_label(
        """CASE WHEN discount = 0 THEN '0%' WHEN discount < 10 THEN '1–9%'
  WHEN discount BETWEEN 10 AND 19 THEN '10–19%' WHEN discount BETWEEN 20 AND 29 THEN '20–29%'
  WHEN discount BETWEEN 30 AND 49 THEN '30–49%' ELSE '50%+' END""",
        "discount_band",
        "product_count",
        "avg_final_price",
    ),
    "listing_quality": _by_label(
        "CASE WHEN title_word_count < 5 THEN 'sparse' WHEN title_word_count < 10 THEN 'moderate' ELSE 'rich' END",
        "listing_richness",
        "products",
        "avg_price",
        f", {KNOWN} AS with_known_seller",
    ),
    "revenue_by_category": _star(f"""
SELECT category_slug, COUNT(*) AS products, {_avg('rating', 2)} AS avg_rating,
  {_sum('final_price', 0)} AS revenue
FROM processed GROUP BY 1 ORDER BY revenue DESC NULLS LAST, category_slug NULLS LAST LIMIT 10"""),
    "product_sample": _star("""
SELECT product_id, title, category_slug, rating, final_price, price_bucket
FROM processed ORDER BY product_id LIMIT 20"""),
    # ------------------------------------------------------------ analytics
    "kpi_snapshot": _star(f"""
SELECT COUNT(*) AS total_products, {_avg('rating', 2)} AS avg_rating, {_avg('discount', 1)} AS avg_discount,
  {_avg('final_price', 0)} AS avg_selling_price, {_sum('final_price', 0)} AS revenue_potential,
  {DISCOUNTED} AS discounted_products, {KNOWN} AS known_sellers, COUNT(DISTINCT category_slug) AS categories
FROM processed"""),
    "kpi_labels": _star(f"""
, k AS (
  SELECT COUNT(*) AS n, {_avg('rating', 2)} AS r, {_avg('discount', 1)} AS d, {_avg('final_price', 0)} AS p,
    {_sum('final_price', 0)} AS rev, {DISCOUNTED} AS disc, {KNOWN} AS known, COUNT(DISTINCT category_slug) AS c
  FROM processed)
SELECT 'Total Products' AS kpi, format('{{:,}}', n) AS label FROM k
UNION ALL SELECT 'Avg Rating', format('{{:.2f}} / 5', r) FROM k
UNION ALL SELECT 'Avg Discount', format('{{:.1f}}%', d) FROM k
UNION ALL SELECT 'Avg Selling Price', format('INR {{:,}}', CAST(p AS BIGINT)) FROM k
UNION ALL SELECT 'Revenue Potential', format('INR {{:,}}', CAST(rev AS BIGINT)) FROM k
UNION ALL SELECT 'Discounted Products', format('{{:,}}', disc) FROM k
UNION ALL SELECT 'Known Sellers', format('{{:,}}', known) FROM k
UNION ALL SELECT 'Categories', CAST(c AS VARCHAR) FROM k"""),
    "top_categories_nb": _star(f"""
SELECT category_slug AS category, {_sum('coalesce(final_price, 0)', 2)} AS revenue
FROM processed WHERE category_slug IS NOT NULL GROUP BY 1 ORDER BY revenue DESC, category LIMIT 10"""),
    "price_bucket_counts": _star("""
SELECT price_bucket, nullif(COUNT(p.product_id), 0) AS products
FROM (VALUES ('budget'), ('mid_range'), ('premium'), ('luxury')) v(price_bucket)
LEFT JOIN processed p USING (price_bucket) GROUP BY 1"""),
    "price_bucket_share": _star(f"""
SELECT price_bucket, COUNT(*) AS products, {_share('COUNT(*)', TOTAL)} AS share_pct
FROM processed WHERE price_bucket <> 'unknown' GROUP BY 1"""),
    "rating_histogram": _histogram(
        "rating", f", (SELECT {_avg('rating', 6)} FROM processed) AS mean_rating"
    ),
    "rating_tier_counts": _star("SELECT ratings_tier, COUNT(*) AS products FROM processed GROUP BY 1"),
    "discount_rating_scatter": _star("SELECT discount, rating, final_price FROM processed"),
    "discount_rating_trend": _star("""
, fit AS (
  SELECT regr_slope(rating, discount) AS a, regr_intercept(rating, discount) AS b,
    min(discount) AS lo, max(discount) AS hi FROM processed),
line AS (
  SELECT i + 1 AS point, a, b, CASE WHEN i = 99 THEN hi ELSE i * ((hi - lo) / 99) + lo END AS x
  FROM fit, range(100) t(i))
SELECT CAST(point AS INTEGER) AS point, round(x, 6) AS discount, round(a * x + b, 6) AS rating
FROM line"""),
    "discount_rating_corr": _star("""
SELECT CASE WHEN NOT isnan(c) THEN round(c, 6) END AS correlation
FROM (SELECT corr(discount, rating) AS c FROM processed)"""),
    "top_products_nb": _star("""
SELECT title, category_slug, rating, ratings_count, final_price, rating_x_count,
  substr(title, 1, 35) || '...' AS short_title
FROM processed ORDER BY rating_x_count DESC NULLS LAST, product_id LIMIT 10"""),
    "category_heatmap": _star(f"""
, best AS (
  SELECT category_slug, {_avg('rating', 2)} AS avg_rating, {_avg('discount', 1)} AS avg_discount,
    {_avg('final_price', 0)} AS avg_price, COUNT(*) AS products
  FROM processed GROUP BY 1 HAVING COUNT(*) >= 5
  ORDER BY avg_rating DESC NULLS LAST, category_slug NULLS LAST LIMIT 15)
SELECT *,
  (avg_rating - min(avg_rating) OVER ()) / nullif(max(avg_rating) OVER () - min(avg_rating) OVER (), 0) AS avg_rating_norm,
  (avg_discount - min(avg_discount) OVER ()) / nullif(max(avg_discount) OVER () - min(avg_discount) OVER (), 0) AS avg_discount_norm,
  (avg_price - min(avg_price) OVER ()) / nullif(max(avg_price) OVER () - min(avg_price) OVER (), 0) AS avg_price_norm
FROM best"""),
    # ------------------------------------------------------------ dashboard
    "dash_discount_split": _star(f"""
SELECT is_discounted, COUNT(*) AS products, {_share('COUNT(*)', TOTAL)} AS share_pct
FROM processed GROUP BY 1"""),
    "dash_scatter": _star("SELECT product_id, rating, final_price, price_bucket FROM processed"),
    "dash_price_histogram": _histogram("final_price"),
    "dash_category_bucket_matrix": _star("""
SELECT category_slug, COUNT(*) FILTER (WHERE price_bucket = 'budget') AS budget,
  COUNT(*) FILTER (WHERE price_bucket = 'mid_range') AS mid_range,
  COUNT(*) FILTER (WHERE price_bucket = 'premium') AS premium,
  COUNT(*) FILTER (WHERE price_bucket = 'luxury') AS luxury,
  COUNT(*) FILTER (WHERE price_bucket = 'unknown') AS unknown
FROM processed GROUP BY 1"""),
    "dash_category_discount": _star(
        f"SELECT category_slug, {_avg('discount', 1)} AS avg_discount_pct FROM processed GROUP BY 1"
    ),
    "dash_known_seller_pct": _star(f"SELECT {_share(KNOWN, 'COUNT(*)')} AS known_seller_pct FROM processed"),
    "quality_check": _star("""
, checks AS (
  SELECT 'dim_category' AS table_name, COUNT(*) AS row_count,
    COUNT(*) - COUNT(DISTINCT coalesce(category_slug, '')) AS repeated_keys,
    COUNT(*) FILTER (WHERE category_slug IS NULL) AS missing_keys FROM category
  UNION ALL
  SELECT 'dim_seller', COUNT(*), COUNT(*) - COUNT(DISTINCT coalesce(seller_name, '')),
    COUNT(*) FILTER (WHERE seller_name IS NULL) FROM (SELECT DISTINCT seller_name FROM processed)
  UNION ALL
  SELECT 'dim_product', COUNT(*), COUNT(*) - COUNT(DISTINCT coalesce(product_key, '')),
    COUNT(*) FILTER (WHERE product_key IS NULL) FROM processed
  UNION ALL
  SELECT 'fact_product_listing', COUNT(*), COUNT(*) - COUNT(DISTINCT coalesce(product_key, '')),
    COUNT(*) FILTER (WHERE product_key IS NULL) FROM processed)
SELECT table_name, 'row_count' AS check_name, row_count AS observed, row_count > 0 AS passed, true AS blocking
FROM checks
UNION ALL SELECT table_name, 'repeated_keys', repeated_keys, repeated_keys = 0, true FROM checks
UNION ALL SELECT table_name, 'missing_keys', missing_keys, missing_keys = 0, false FROM checks
UNION ALL SELECT 'fact_product_listing', 'ratings_out_of_range', COUNT(*) FILTER (WHERE rating < 0 OR rating > 5),
  COUNT(*) FILTER (WHERE rating < 0 OR rating > 5) = 0, false FROM processed
UNION ALL SELECT 'fact_product_listing', 'negative_discounts', COUNT(*) FILTER (WHERE discount_amount < 0),
  COUNT(*) FILTER (WHERE discount_amount < 0) = 0, false FROM processed
UNION ALL SELECT 'fact_product_listing', 'orphans_of_dim_category', COUNT(*), COUNT(*) = 0, true
  FROM processed p WHERE category_slug IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM category c WHERE c.category_slug = p.category_slug)
UNION ALL SELECT 'fact_product_listing', 'orphans_of_dim_seller', COUNT(*), COUNT(*) = 0, true
  FROM processed p WHERE seller_name IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT seller_name FROM processed) s WHERE s.seller_name = p.seller_name)
UNION ALL SELECT 'fact_product_listing', 'orphans_of_dim_product', COUNT(*), COUNT(*) = 0, true
  FROM processed p WHERE product_key IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM (SELECT product_key FROM processed) d WHERE d.product_key = p.product_key)"""),
}

# However the versions arrive and are compacted, the newest ones are the same.
ORACLE_SQL["stream_latest_compacted"] = ORACLE_SQL["stream_dedup_latest"]
