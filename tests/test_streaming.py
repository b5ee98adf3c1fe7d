"""Streams against their batch counterparts, restarts included."""

import os
from datetime import datetime

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans.transform import identified, latest_versions, process
from shelfwise.schema import LAKE_SCHEMA
from shelfwise.sources import lake
from shelfwise.streaming import jobs, messages, snapshots
from tests.test_operators import raw_rows

NUMBERS = T.StructType([T.StructField("n", T.LongType())])


def add_files(path, first, sizes):
    path.mkdir(exist_ok=True)
    n = sum(len(pd.read_parquet(p)) for p in path.glob("*.parquet"))
    for i, size in enumerate(sizes, start=first):
        pd.DataFrame({"n": range(n, n + size)}).to_parquet(path / f"part-{i:03d}.parquet")
        n += size


def test_replay_numbers_batches_across_restarts(spark, tmp_path):
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")

    def run():
        rows = jobs.file_stream(spark, str(source), NUMBERS, files_per_trigger=2)
        jobs.replay(rows, out, marks, batch_rows=50).awaitTermination()
        return jobs.read_replay(spark, out, NUMBERS).orderBy("_row_id").collect()

    add_files(source, 0, [30, 75, 5])
    first = run()
    assert [(r._row_id, r.n, r._batch_id) for r in first] == [(i, i, i // 50) for i in range(110)]
    assert run() == first  # nothing new, nothing repeated
    add_files(source, 3, [60])
    assert [(r._row_id, r.n, r._batch_id) for r in run()] == [(i, i, i // 50) for i in range(170)]


@pytest.mark.parametrize("files_per_trigger", [1, 2, 100])
def test_replay_numbers_follow_paths_whatever_the_triggers(spark, tmp_path, files_per_trigger):
    """Files that changed last come first by path, and in any number per trigger."""
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")

    def run():
        rows = jobs.file_stream(spark, str(source), NUMBERS, files_per_trigger)
        jobs.replay(rows, out, marks, source=str(source)).awaitTermination()
        return [(r._row_id, r.n, r._batch_id) for r in jobs.read_replay(spark, out, NUMBERS).orderBy("_row_id").collect()]

    add_files(source, 0, [30, 75, 5, 60])
    for age, name in enumerate(["part-002", "part-000", "part-003", "part-001"]):
        os.utime(source / f"{name}.parquet", (1_700_000_000 + age, 1_700_000_000 + age))
    assert run() == [(i, i, i // 50) for i in range(170)]
    late = source / "a-comes-first-by-path.parquet"  # but the numbers of others are given by now
    pd.DataFrame({"n": range(170, 180)}).to_parquet(late)
    assert run() == [(i, i, i // 50) for i in range(180)]
    assert spark.read.parquet(f"{out}/files").count() == 5


def test_repeated_micro_batch_overwrites_itself(spark, tmp_path):
    """A second checkpoint replays the same epochs into the same directories."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    add_files(source, 0, [30, 75, 5])
    for marks in ("a", "b"):
        rows = jobs.file_stream(spark, str(source), NUMBERS, files_per_trigger=1)
        jobs.replay(rows, out, str(tmp_path / marks)).awaitTermination()
    assert jobs.read_replay(spark, out, NUMBERS).count() == 110


def test_crash_between_rows_and_end_mark(spark, tmp_path, monkeypatch):
    """The unfinished micro-batch is not read, and a restart writes it anew."""
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")

    def run():
        rows = jobs.file_stream(spark, str(source), NUMBERS, files_per_trigger=1)
        jobs.replay(rows, out, marks, batch_rows=50).awaitTermination()

    def crash(*args, **more):
        raise RuntimeError("lost before the end mark")

    add_files(source, 0, [30])
    run()
    add_files(source, 1, [75])
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "_note", crash)
        with pytest.raises(StreamingQueryException, match="lost before the end mark"):
            run()
    assert spark.read.parquet(f"{out}/rows").count() == 105  # written, but not finished
    assert jobs.read_replay(spark, out, NUMBERS).count() == 30
    run()
    rows = jobs.read_replay(spark, out, NUMBERS).orderBy("_row_id").collect()
    assert [(r._row_id, r.n, r._batch_id) for r in rows] == [(i, i, i // 50) for i in range(105)]


def versions(spark, path, stamps):
    for i, (product, batch, title) in enumerate(stamps):
        row = {"product_id": product, "_batch_id": batch, "title": title}
        raw_rows(spark, [row]).coalesce(1).write.mode("append").parquet(f"{path}/{i:03d}")


def test_fold_latest_is_the_batch_result(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")

    def run():
        rows = jobs.file_stream(spark, source, LAKE_SCHEMA, files_per_trigger=2)
        known = identified(rows)
        jobs.fold_latest(known, out, marks, "product_key").awaitTermination()
        return sorted(jobs.read_latest(spark, out, known.schema, "product_key").collect(), key=str)

    def batch():
        return sorted(latest_versions(spark.read.schema(LAKE_SCHEMA).parquet(f"{source}/*")).collect(), key=str)

    versions(spark, source, [("1", 5, "new"), ("2", 1, "only"), ("1", 3, "late and old"), (None, 1, "x"), ("2.0", 2, "same")])
    got = run()
    assert {(r.product_id, r.title) for r in got} == {(1, "new"), (2, "same"), (None, "x")}
    assert got == batch()
    assert run() == got

    schema = identified(spark.read.schema(LAKE_SCHEMA).parquet(f"{source}/*")).schema
    for _ in range(2):  # the second finds nothing to do
        jobs.compact_latest(spark, out, schema, "product_key")
        assert run() == got
    for i, stamp in enumerate([("1", 4, "older than the snapshot"), ("2", 9, "newer"), ("3", 1, "first")]):
        raw_rows(spark, [dict(zip(["product_id", "_batch_id", "title"], stamp))]).coalesce(1).write.parquet(
            f"{source}/9{i}"
        )
    after = run()
    assert {(r.product_id, r.title) for r in after} == {(1, "new"), (2, "newer"), (3, "first"), (None, "x")}
    assert after == batch()

    raw = spark.read.schema(LAKE_SCHEMA).parquet(f"{source}/*")
    kept = process(raw, newest=jobs.read_latest(spark, out, schema, "product_key"))
    assert sorted(kept.collect(), key=str) == sorted(process(raw).collect(), key=str)


def test_fold_latest_sorts_what_is_left(spark, tmp_path, monkeypatch):
    """A micro-batch drops superseded rows before the group limit sorts whole ones."""
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    rows = [{"product_id": str(i % 2), "_ingested_at": datetime(2024, 1, 1 + i), "title": str(i)} for i in range(20)]
    raw_rows(spark, rows).coalesce(1).write.parquet(f"{source}/000")
    left, keep_latest = [], jobs.keep_latest

    def counted(batch, *args):
        left.append(batch.count())
        return keep_latest(batch, *args)

    monkeypatch.setattr(jobs, "keep_latest", counted)
    known = identified(jobs.file_stream(spark, source, LAKE_SCHEMA))
    jobs.fold_latest(known, out, marks, "product_key").awaitTermination()
    assert left == [2]
    monkeypatch.undo()
    got = jobs.read_latest(spark, out, known.schema, "product_key").collect()
    assert sorted(r.title for r in got) == ["18", "19"]


def test_land_appends_to_the_lake(spark, tmp_path):
    source, target, marks = str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "marks")
    versions(spark, source, [("1", 1, "a"), ("2", 1, "b")])
    for _ in range(2):
        rows = jobs.file_stream(spark, source, LAKE_SCHEMA)
        jobs.land(rows, target, marks).awaitTermination()
    landed = lake.read_lake(spark, target)
    assert sorted(r.title for r in landed.collect()) == ["a", "b"]
    assert landed.where("_ingested_at is null").count() == 0

    ours = str(tmp_path / "batch")
    rows = raw_rows(spark, [{"product_id": "3", "title": "c"}]).withColumn("_ingested_at", lake.utc_now())
    lake.append_to_lake(rows, ours)
    assert sorted(r.title for r in lake.read_lake(spark, target, ours).collect()) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="belongs to a stream"):
        lake.append_to_lake(rows, target)
    with pytest.raises(ValueError, match="files of batch jobs"):
        jobs.land(jobs.file_stream(spark, source, LAKE_SCHEMA), ours, marks)


def test_messages_keep_nulls(spark):
    rows = raw_rows(spark, [{"product_id": "1", "title": '₹ "quoted"\n', "rating": None}])
    encoded = messages.encode(rows)
    assert '"rating":null' in encoded.first().value
    assert messages.decode(encoded).collect() == rows.collect()
    as_bytes = encoded.select(F.col("value").cast("binary").alias("value"))
    assert messages.decode(as_bytes).collect() == rows.collect()


def test_topic_messages_get_their_place(spark):
    listing = messages.encode(raw_rows(spark, [{"product_id": "1", "title": "t"}])).first().value
    topic = spark.createDataFrame(
        [(bytearray(listing, "utf8"), 3, 41), (bytearray(b"not json"), 3, 42)],
        "value binary, partition int, offset long",
    )
    rows = messages.from_topic(topic).orderBy("_row_id").collect()
    assert [(r.product_id, r.title, r._batch_id, r._row_id) for r in rows] == [
        ("1", "t", 3, 41), (None, None, 3, 42),
    ]


def exchanged(frame):
    """The formatted plan's exchanges, with the scans below each."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line], plan


def test_a_snapshot_is_merged_in_its_buckets(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")

    def fold():
        known = identified(jobs.file_stream(spark, source, LAKE_SCHEMA))
        jobs.fold_latest(known, out, marks, "product_key").awaitTermination()
        return known.schema

    def titles(schema):
        rows = jobs.read_latest(spark, out, schema, "product_key").collect()
        return sorted((r.product_key or "", r.title) for r in rows)

    first = [{"product_id": str(i), "_batch_id": 1, "title": "a"} for i in range(40)] + [{"_batch_id": 1, "title": "a"}]
    raw_rows(spark, first).write.parquet(f"{source}/0")
    schema = fold()
    jobs.compact_latest(spark, out, schema, "product_key", buckets=8)
    start = snapshots.last_snapshot(spark, out)
    assert start.buckets == 8 and set(start.upto.values()) == {start.position} and len(start.upto) > 5

    later = [{"product_id": "7", "_batch_id": 2, "title": "b"}, {"product_id": "9", "_batch_id": 0, "title": "old"}]
    raw_rows(spark, [*later, {"product_id": "99", "_batch_id": 1, "title": "a"}, {"_batch_id": 2, "title": "b"}]).write.parquet(f"{source}/1")
    fold()
    expected = sorted([(str(i), "b" if i == 7 else "a") for i in [*range(40), 99]] + [("", "b")])
    merged = jobs.read_latest(spark, out, schema, "product_key")
    exchanges, plan = exchanged(merged)
    assert len(exchanges) == 1 and "REPARTITION_BY_NUM" in exchanges[0], plan
    assert "Bucketed: true" in plan and titles(schema) == expected

    jobs.compact_latest(spark, out, schema, "product_key", buckets=3, grace_seconds=0)
    end = snapshots.last_snapshot(spark, out)
    touched = {b for b, upto in end.upto.items() if upto == end.position}
    keys = spark.createDataFrame([("7",), ("9",), ("99",), (None,)], "product_key STRING")
    assert end.buckets == 8 and touched == {r[0] for r in keys.select(snapshots.bucket_of("product_key", 8)).collect()}
    assert titles(schema) == expected
    left = {p.parent.name for p in (tmp_path / "out").glob("snapshots/upto=0/*/*.parquet")}
    assert left == {f"_bucket={b}" for b, upto in end.upto.items() if upto == 0}
    assert not list((tmp_path / "out").glob("changes/*/*.parquet"))

    for _ in range(2):  # there is nothing to do
        jobs.compact_latest(spark, out, schema, "product_key", grace_seconds=0)
    assert snapshots.snapshots(spark, out) == [end] and fold() == schema and titles(schema) == expected


def test_a_compaction_keeps_what_readers_may_use(spark, tmp_path):
    source, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    for i in range(2):
        raw_rows(spark, [{"product_id": "1", "_batch_id": i, "title": str(i)}]).write.parquet(f"{source}/{i}")
        known = identified(jobs.file_stream(spark, source, LAKE_SCHEMA))
        jobs.fold_latest(known, out, marks, "product_key").awaitTermination()
        before = jobs.read_latest(spark, out, known.schema, "product_key")
        jobs.compact_latest(spark, out, known.schema, "product_key")
        assert [r.title for r in before.collect()] == [str(i)]
    assert len(snapshots.snapshots(spark, out)) == 2
