"""The star schema."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.schema import (
    DIM_CATEGORY_SCHEMA,
    DIM_PRODUCT_SCHEMA,
    DIM_SELLER_SCHEMA,
    FACT_SCHEMA,
)

TABLE_SCHEMAS = {
    "dim_category": DIM_CATEGORY_SCHEMA,
    "dim_seller": DIM_SELLER_SCHEMA,
    "dim_product": DIM_PRODUCT_SCHEMA,
    "fact_product_listing": FACT_SCHEMA,
}


@dataclass(frozen=True)
class Star:
    dim_category: DataFrame
    dim_seller: DataFrame
    dim_product: DataFrame
    fact_product_listing: DataFrame

    def register(self) -> None:
        """Makes the tables known to SQL as temporary views."""
        for field in fields(self):
            getattr(self, field.name).createOrReplaceTempView(field.name)


def dim_category(processed: DataFrame) -> DataFrame:
    """One name per slug: that of the product with the least identifier.

    Pairs of slug and name are collapsed first, by hash and before the shuffle;
    the choice among a slug's names then sees few rows.
    """
    least = F.struct(F.col("product_id").isNull(), "product_id", F.col("product_key").isNull(), "product_key")
    names = processed.groupBy("category_slug", "category").agg(F.min(least).alias("first"))
    order = F.struct("first", "category")
    return names.groupBy("category_slug").agg(F.min_by("category", order).alias("category_name"))


def dim_seller(processed: DataFrame) -> DataFrame:
    return processed.select("seller_name").distinct()


def dim_product(processed: DataFrame) -> DataFrame:
    """A projection: the processed table has one row per product already."""
    return processed.select(*DIM_PRODUCT_SCHEMA.fieldNames())


def fact_product_listing(processed: DataFrame) -> DataFrame:
    return processed.select(*FACT_SCHEMA.fieldNames())


BUILDERS = {
    "dim_category": dim_category,
    "dim_seller": dim_seller,
    "dim_product": dim_product,
    "fact_product_listing": fact_product_listing,
}


def build_star(processed: DataFrame) -> Star:
    """The four tables as lazy frames over a written processed table."""
    return Star(**{name: build(processed) for name, build in BUILDERS.items()})


def write_star(processed: DataFrame, path: str) -> None:
    """Replaces the four tables below `path`."""
    for name, build in BUILDERS.items():
        build(processed).write.mode("overwrite").parquet(f"{path}/{name}")


def read_star(spark: SparkSession, path: str) -> Star:
    return Star(
        **{
            name: spark.read.schema(schema).parquet(f"{path}/{name}")
            for name, schema in TABLE_SCHEMAS.items()
        }
    )
