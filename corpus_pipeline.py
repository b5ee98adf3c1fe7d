"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import contamination, jaccard_join, packing, private_data, quality_classifier
from shelfwise.llm.frames import written

#: Documents with a lower score for quality go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels
    of documents that are still there."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    scored = quality_classifier.add_scores(docs, model)
    return scored.where(F.col("score") >= LEAST_QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id.
    Documents are told apart by doc_id, so rows that share one stay or go together."""
    groups = jaccard_join.near_duplicates(docs)
    gone = written(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    found = contamination.find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.col("n_hit") == 0).select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by their kinds."""
    found = private_data.find_private(docs)
    clean = found.withColumn("text", private_data.redact(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("private data", private),
    ("packing", pack),
]

#: The first stage is a learned model, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{i}-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
