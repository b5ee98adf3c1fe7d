"""One row as one JSON message, and Kafka as its carrier.

The encoder and decoder are plain projections, usable on batches and streams.
Kafka itself needs Spark's connector package on the class path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.config import ListingConfig
from shelfwise.schema import LAKE_SCHEMA, RAW_SCHEMA


def encode(df: DataFrame) -> DataFrame:
    """Every row as a JSON object in `value`; NULLs are written out."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(row.alias("value"))


def decode(messages: DataFrame, schema: T.StructType = LAKE_SCHEMA) -> DataFrame:
    """Rows of a schema from `value`, text or bytes."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(parsed.alias("record")).select("record.*")


def from_topic(messages: DataFrame, extra_columns: Sequence[str] = ()) -> DataFrame:
    """Listings of a topic's messages; their place in the topic orders them.

    Partition and offset take the place of batch and row number. A stream's
    columns are fixed when it starts, so further ones are named by the caller.
    """
    schema = T.StructType([*RAW_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in extra_columns]])
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(
        parsed.alias("record"),
        F.col("partition").cast("bigint").alias("_batch_id"),
        F.col("offset").alias("_row_id"),
    ).select("record.*", "_batch_id", "_row_id")


def kafka_source(
    spark: SparkSession, conf: ListingConfig = ListingConfig(), extra_columns: Sequence[str] = ()
) -> DataFrame:
    """A topic as a stream of listings, for `jobs.land` or `jobs.fold_latest`."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", conf.kafka_servers)
        .option("subscribe", conf.kafka_topic)
        .option("startingOffsets", conf.kafka_starting_offsets)
        .load()
    )
    return from_topic(messages, extra_columns)


def kafka_sink(rows: DataFrame, checkpoint: str, conf: ListingConfig = ListingConfig()) -> StreamingQuery:
    return (
        encode(rows)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", conf.kafka_servers)
        .option("topic", conf.kafka_topic)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
