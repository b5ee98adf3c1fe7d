"""Number keys as columns, for frames of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import key_to_identifier, other_key, whole_number


def with_number_key(df: DataFrame, text: Column, key: str = "product_key", identifier: str = "product_id") -> DataFrame:
    """Adds the `number_key` of a text and the BIGINT that it names, if any.

    Both use the columns of the projections below more than once, so Spark keeps
    those apart and computes them once. All but the first are NULL for whole numbers
    of up to 18 digits, as nearly all identifiers are.
    """
    steps = df.withColumn("_key_text", text).withColumn("_key_whole", whole_number(F.col("_key_text")))
    whole, other = F.col("_key_whole"), F.col("_key_other")
    steps = steps.withColumn("_key_other", other_key(F.col("_key_text"), whole))
    return steps.withColumns(
        {key: F.coalesce(whole.cast("string"), other), identifier: F.coalesce(whole, key_to_identifier(other))}
    ).drop("_key_text", "_key_whole", "_key_other")
