"""A raw listing feed derived from the sample order tables.

One row per order line; later lines of a part are newer versions of a product.
The texts are as dirty as a real feed: prices with symbols, missing values,
tokens, blanks, changing case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.schema import LAKE_SCHEMA


def sample_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the raw lake's schema. Both joins are left to the optimizer."""
    lines = _spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    order, supplier = F.col("l_orderkey"), F.col("l_suppkey")
    list_cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity"))
    sale_cents = F.floor(list_cents * (1 - F.col("l_discount") * 6.5))
    long_title = F.concat_ws(" ", "p_name", "p_brand", "p_type", F.lit("size"), "p_size")
    case_type = F.when(F.col("l_linenumber") % 2 == 0, F.upper("p_type")).otherwise(F.lower("p_type"))
    percent = (F.col("l_discount") * 650).cast("decimal(6,2)").cast("string")
    stars = (F.col("l_quantity") * 0.11).cast("decimal(4,2)").cast("string")

    values = {
        "product_id": F.col("l_partkey").cast("string"),
        "title": F.when(F.col("p_size") % 3 == 0, F.col("p_name"))
        .when(F.col("p_size") % 3 == 1, long_title)
        .otherwise(F.concat_ws(" ", long_title, F.lit("sold by"), "s_name", F.lit("new sealed"))),
        "category": F.concat(F.lit("  "), case_type, F.lit("   "), "p_brand", F.lit(" ")),
        "currency": F.lit("INR"),
        "initial_price": _units(list_cents),
        "final_price": F.when(order % 13 == 0, None)
        .when(order % 17 == 0, "Price on request")
        .otherwise(F.concat(F.lit("₹"), _units(sale_cents, grouped=True))),
        "discount": F.when(order % 11 != 0, percent),
        "rating": F.when(order % 19 != 0, stars),
        "ratings_count": F.when(order % 23 == 0, "n/a").otherwise((order % 997).cast("string")),
        "seller_name": F.when(~(supplier % 10).isin(3, 7, 9), F.col("s_name")),
        "videos": F.lit(None),
        "variations": F.when(F.col("l_linestatus") != "F", "S,M,L"),
        "seller_information": F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")),
        "what_customers_said": F.when(F.col("l_returnflag") == "R", "mixed").otherwise(
            F.col("l_tax").cast("decimal(4,2)").cast("string")
        ),
        "_ingested_at": F.col("l_shipdate"),
        "_batch_id": order,
        "_row_id": F.col("l_linenumber"),
    }
    return joined.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in LAKE_SCHEMA.fields]
    )


def number_forms(feed: DataFrame) -> DataFrame:
    """A feed whose identifiers are written in many ways, by `_batch_id`: as whole
    numbers with signs, blanks, zeros, points and exponents, as fractions, as numbers
    beyond any integer or double, and as no numbers."""
    number = F.col("product_id")
    forms = [
        number,
        F.concat(F.lit("+"), number, F.lit(".0")),
        F.concat(F.lit(" "), number, F.lit(" ")),
        F.concat(F.lit("00"), number),
        F.concat(number, F.lit("0e-1")),
        F.concat(number, F.lit(".5")),
        F.concat(number, F.lit("5E-1")),
        F.concat(number, F.lit("e40")),
        F.concat(F.lit("-"), number),
        F.concat(number, F.lit("e9999999999")),
        F.concat(number, F.lit("00e9999999998")),
        F.concat(F.lit("part "), number),
        F.concat(number, F.lit("00000000000000000000.25")),
        F.lit("Infinity"),
    ]
    position = (F.col("_batch_id") % len(forms) + 1).cast("int")
    return feed.withColumn("product_id", F.element_at(F.array(*forms), position))


def _units(cents: Column, grouped: bool = False) -> Column:
    """Cents as units and two digits, with a thousands comma if grouped."""
    whole = F.floor(cents / 100)
    rest = F.lpad((cents % 100).cast("string"), 2, "0")
    text = whole.cast("string")
    if grouped:
        thousands = F.concat(
            F.floor(whole / 1000).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0")
        )
        text = F.when(whole >= 1000, thousands).otherwise(text)
    return F.concat(text, F.lit("."), rest)


def _spread(lines: DataFrame) -> DataFrame:
    """Shuffles a table that would be read by fewer tasks than there are cores.

    A table of many files or large files is left as it is.
    """
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines if lines.rdd.getNumPartitions() >= cores else lines.repartition(cores)
