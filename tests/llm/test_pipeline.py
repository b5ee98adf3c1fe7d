"""Registered queries beside their SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from shelfwise.llm import contamination, jaccard_join, private_data, queries
from shelfwise.llm.frames import written
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    got = contract.queries()[name](spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).execute(contract.oracle_sql()[name]).df()) is None
    assert len(got) > 0


def test_all_are_registered():
    found = contract.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name[: name.index("_") + 1] for name in found if name in queries.QUERIES}
    assert found["pipeline"] is corpus_pipeline.run


def test_every_document_is_scored(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert queries.op3_private_data(spark, SMALL).count() == n
    assert queries.op8_suffix_dedup(spark, SMALL).count() == n


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SMALL}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    kept = written(steps["quality classifier"](spark, docs, SMALL), "a")
    assert kept.columns == columns
    bad, good = (labels.where(f"quality = {q}").join(kept, "doc_id").count() / labels.where(f"quality = {q}").count() for q in (0, 1))
    assert bad < 0.1 and good > 0.97
    apart = written(steps["n-gram Jaccard join"](spark, kept, SMALL), "b")
    groups = jaccard_join.near_duplicates(kept)
    assert {r.doc_id for r in apart.collect()} == {r.component_id for r in groups.collect()}
    clean = written(steps["benchmark decontamination"](spark, apart, SMALL), "c")
    found = contamination.find_passages(apart, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in found.where("n_hit = 0").collect()}
    redacted = written(steps["private data"](spark, clean, SMALL), "d")
    assert redacted.columns == columns and redacted.count() == clean.count()
    left = redacted.select(private_data.base_spans(F.col("text")).alias("s"), "text", "n_chars")
    assert left.where("size(s) > 0 or n_chars <> char_length(text)").count() == 0
    pieces = steps["packing"](spark, redacted, SMALL)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in redacted.collect()}


def test_rows_with_nulls_and_repeats_pass(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "xx", "s", 0), (-1, "", "xx", "s", 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.union(odd), SMALL).count() >= 0, name
