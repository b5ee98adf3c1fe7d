"""CSV, micro-batches and the raw lake."""

import os
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans.transform import process
from shelfwise.schema import ATTEMPT, LAKE_SCHEMA
from shelfwise.sources import lake, manifest
from shelfwise.sources.batches import micro_batches, source_ordinal, with_split
from shelfwise.sources.csv import scan_listing_csv
from tests.test_operators import raw_rows

CSV = '''product_id,title,videos
1,"two
lines, ""quoted""",v
2,NA,"NA"

3, NA ,None
4,n/a
5,"",null
'''


def test_csv(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(CSV)
    rows = [tuple(r) for r in scan_listing_csv(spark, str(path)).collect()]
    assert rows == [
        ("1", 'two\nlines, "quoted"', "v"),
        ("2", None, None),
        ("3", " NA ", None),
        ("4", None, None),
        ("5", None, None),
    ]


def test_csv_matches_pandas(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(CSV)
    expected = pd.read_csv(path, dtype=str)
    got = scan_listing_csv(spark, str(path)).toPandas()
    pd.testing.assert_frame_equal(
        got.astype(object).where(got.notna(), None), expected.astype(object).where(expected.notna(), None)
    )


@pytest.mark.parametrize("row", ["3,4,5", "3,4,", '3,"4","5",6', '"x\ny",4,5'])
@pytest.mark.parametrize("column", ["a", "b"])
def test_csv_surplus_value_fails(spark, tmp_path, row, column):
    path = tmp_path / "feed.csv"
    path.write_text(f"a,b\n1,2\n{row}\n5\n")
    with pytest.raises(Exception, match="more than 2 values"):
        scan_listing_csv(spark, str(path)).select(column).collect()
    with pytest.raises(Exception, match="more than 2 values"):
        scan_listing_csv(spark, str(path)).count()


def test_csv_other_header_fails(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        scan_listing_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    "text, rows",
    [
        ('a,b\n1,"x"\n2,"y ""z"" w"\n', 2),  # every row on a line of its own
        ('a,b\n1,"x\ny"\n', 1),
        ('a,b\n5" nail,"x\ny"\n', 1),  # an even number of quotes, and yet open
        ('a,b\n1,"""x\n"""\n', 1),
        ('a,b\r\n1,x\r\n2,"y"\r\n', 2),
    ],
)
def test_csv_line_breaks_are_found(spark, tmp_path, text, rows):
    path = tmp_path / "feed.csv"
    path.write_bytes(text.encode())
    got = scan_listing_csv(spark, str(path)).collect()
    assert len(got) == rows
    assert got == scan_listing_csv(spark, str(path), multi_line=True).collect()


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("a,b\n" + '1,"x, y"\n' * 10000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        rows = scan_listing_csv(spark, str(path))
        assert rows.rdd.getNumPartitions() > 4
        assert rows.where("b = 'x, y'").count() == 10000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_missing_path_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_listing_csv(spark, str(tmp_path / "absent.csv"))


def test_ordinals_follow_files_and_rows(spark, tmp_path):
    """Files of unequal size, which tasks pack in another order than by path."""
    expected = []
    for part, size in enumerate([10, 400, 1, 90, 250]):
        values = list(range(len(expected), len(expected) + size))
        pd.DataFrame({"n": values}).to_parquet(tmp_path / f"part-{part}.parquet")
        expected += values
    scan = with_split(spark.read.parquet(str(tmp_path)))
    rows = source_ordinal(scan).collect()
    assert sorted((r._ordinal, r.n) for r in rows) == [(n, n) for n in expected]


def test_parquet_rows_are_numbered_without_a_copy(spark, tmp_path):
    for part in range(3):
        pd.DataFrame({"n": range(part * 10, part * 10 + 10)}).to_parquet(tmp_path / f"part-{part}.parquet")
    numbered = source_ordinal(with_split(spark.read.parquet(str(tmp_path))))
    assert numbered.columns == ["n", "_ordinal"] and {os.path.dirname(f) for f in numbered.inputFiles()} == {f"file://{tmp_path}"}


def test_ordinals_over_split_text(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("n,pad\n" + "".join(f"{i},{'x' * 50}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        rows = scan_listing_csv(spark, str(path))
        assert rows.rdd.getNumPartitions() > 4
        got = micro_batches(with_split(rows), 50, 100).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 5000
    assert all(r._row_id == int(r.n) + 100 and r._batch_id == r._row_id // 50 for r in got)


def stamped(spark):
    rows = [
        {"product_id": str(i), "_ingested_at": datetime(2024, 1 + i % 2, 5, i % 24), "_batch_id": i // 50}
        for i in range(200)
    ]
    return raw_rows(spark, rows)


def test_lake_appends_by_hour(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.append_to_lake(stamped(spark), path)
    assert (tmp_path / "lake/ingest_year=2024/ingest_month=1/ingest_day=5/ingest_hour=0").is_dir()
    lake.append_to_lake(stamped(spark), path)
    assert lake.read_lake(spark, path).count() == 400
    hours = lake.hour_counts(lake.read_lake(spark, path)).collect()
    assert len(hours) == 24 and sum(r.rows for r in hours) == 400


def test_lake_reads_only_hours_since(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.append_to_lake(stamped(spark), path)
    since = datetime(2024, 2, 5, 13)
    recent = lake.read_lake(spark, path, since=since)
    assert recent.count() == stamped(spark).where(F.col("_ingested_at") >= F.lit(since)).count()
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(recent.inputFiles()) > 0


def test_since_opens_only_the_files_of_later_hours(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.append_to_lake(stamped(spark), path)
    recent = lake.read_lake(spark, path, since=datetime(2024, 2, 5, 13))
    hours = {f.split("ingest_hour=")[1].split("/")[0] for f in recent.inputFiles()}
    assert hours == {str(h) for h in range(13, 24, 2)}
    for old in (tmp_path / "lake/ingest_year=2024/ingest_month=1").rglob("*.parquet"):
        old.write_bytes(b"no longer readable")  # neither data nor footers of other hours are looked at
    assert recent.count() == lake.read_lake(spark, path, since=datetime(2024, 2, 5, 13)).count() > 0
    assert lake.read_lake(spark, path, since=datetime(2030, 1, 1)).count() == 0


def test_surplus_columns_of_two_types_are_text(spark, tmp_path):
    path = str(tmp_path / "lake")
    for i, extra in enumerate([F.lit("ten"), F.lit(10), F.lit(2.5), None]):
        rows = stamped(spark).limit(2)
        lake.append_to_lake(rows if extra is None else rows.withColumn("extra", extra).withColumn(f"own{i}", F.lit(i)), path)
    got = lake.read_lake(spark, path)
    assert dict(got.dtypes)["extra"] == "string" and dict(got.dtypes)["own1"] == "int"
    assert sorted(str(r.extra) for r in got.collect()) == ["10", "10", "2.5", "2.5", "None", "None", "ten", "ten"]


def test_an_attempt_counts_once_it_is_in_the_log(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = stamped(spark)
    lake.append_to_lake(rows.withColumn(ATTEMPT, F.lit("early")), path)
    lake.append_to_lake(rows.withColumn(ATTEMPT, F.lit("late")), path)
    assert lake.ingest_once(rows.limit(0), path, "nothing") and not lake.ingest_once(rows, path, "nothing")
    assert lake.read_lake(spark, path).count() == 0
    for attempt in ("early", "late"):  # both attempts at one ingest finish
        found = manifest.written_directories(spark, path, attempt, datetime(2024, 1, 5, 0), datetime(2024, 2, 5, 23))
        manifest.commit(spark, path, "one", attempt, found, T.StructType())
        assert lake.read_lake(spark, path).count() == 200
    files = [f for f in (tmp_path / "lake_log").glob("*.parquet")]
    assert len(files) == 3  # one file for each entry


def test_known_columns_are_written_in_the_types_of_the_lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.append_to_lake(stamped(spark).withColumn("product_id", F.lit(7)).withColumn("_batch_id", F.lit(1)), path)
    rows = lake.read_lake(spark, path)
    assert rows.schema["product_id"].dataType == T.StringType() and {r.product_id for r in rows.collect()} == {"7"}


def test_rows_without_an_hour(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.append_to_lake(stamped(spark).withColumn("_ingested_at", F.lit(None).cast("timestamp_ntz")), path)
    lake.append_to_lake(stamped(spark).withColumn("_ingested_at", F.expr("CASE WHEN product_id < 150 THEN _ingested_at END")), path)
    assert lake.read_lake(spark, path).where("ingest_hour IS NULL").count() == 250
    assert lake.read_lake(spark, path).count() == 400


def foreign(tmp_path):
    """Files as a pandas writer leaves them; one has a column without values."""
    rows = [
        ("2024/01/02/03/batch_0000", {"product_id": ["1", "2"], "videos": [None, None], "title": ["a", "b"]}),
        ("2024/01/02/04/batch_0000", {"product_id": ["1", None], "videos": ["x", None], "brand": ["p", "q"]}),
    ]
    for i, (name, columns) in enumerate(rows):
        path = tmp_path / f"{name}.parquet"
        path.parent.mkdir(parents=True)
        stamp = {"_ingested_at": f"2024-01-02T0{3 + i}:00:00.5"} if i else {}
        pd.DataFrame({**columns, **stamp, "_batch_id": 0}).to_parquet(path, index=False)
    return str(tmp_path)


def test_foreign_lake(spark, tmp_path):
    rows = lake.read_foreign_lake(spark, foreign(tmp_path), ["brand"]).orderBy("_ingested_at", "_row_id").collect()
    assert [(r.product_id, r.title, r.videos, r.brand, r._row_id) for r in rows] == [
        ("1", "a", None, None, 0),
        ("2", "b", None, None, 1),
        ("1", None, "x", "p", 0),
        (None, None, None, "q", 1),
    ]
    assert rows[0]._ingested_at == datetime(2024, 1, 2, 3)  # from the path
    assert rows[2]._ingested_at == datetime(2024, 1, 2, 4, 0, 0, 500000)
    assert spark.conf.get("spark.sql.parquet.enableVectorizedReader") == "true"


def test_foreign_files_of_all_types_are_read_by_the_vectorized_reader(spark, tmp_path):
    """Text, numbers, instants and columns without values, in one column each."""
    stamp = pd.Timestamp("2024-01-02T03:04:05.25")
    rows = [
        {"product_id": ["7"], "rating": ["4.5"], "_ingested_at": [stamp]},
        {"product_id": [8], "rating": [4.5], "_ingested_at": [stamp.tz_localize("UTC")], "_batch_id": ["3"]},
        {"product_id": [None], "rating": [None], "_ingested_at": [str(stamp)], "_batch_id": [3.0]},
        {"other": [1, 2]},
        {"videos": [None, None], "unknown": [["a"], ["b"]]},
    ]
    for i, columns in enumerate(rows):
        path = tmp_path / f"2024/02/0{i + 1}/05"
        path.mkdir(parents=True)
        pd.DataFrame(columns).to_parquet(path / "part.parquet", index=False, coerce_timestamps="us")
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary/x.parquet").write_bytes(b"no file")
    found = lake.read_foreign_lake(spark, str(tmp_path))
    got = sorted(((r.product_id, r.rating, r._batch_id, r._ingested_at, r._row_id) for r in found.collect()), key=str)
    at, days = datetime(2024, 1, 2, 3, 4, 5, 250000), [datetime(2024, 2, d, 5) for d in (4, 5)]
    expected = [("7", "4.5", None, at, 0), ("8", "4.5", 3, at, 0), (None, None, 3, at, 0)]
    expected += [(None, None, None, day, i) for day in days for i in (0, 1)]
    assert got == sorted(expected, key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Batched: true" in plan and "Batched: false" not in plan


def test_foreign_lake_without_files(spark, tmp_path):
    with pytest.raises(ValueError, match="no Parquet files"):
        lake.read_foreign_lake(spark, str(tmp_path))


def test_foreign_lake_import(spark, tmp_path):
    target = str(tmp_path / "own")
    lake.import_foreign_lake(spark, foreign(tmp_path / "theirs"), target)
    own = lake.read_lake(spark, target)
    assert set(LAKE_SCHEMA.fieldNames()) < set(own.columns)
    done = {r.product_id: r.videos for r in process(own).collect()}
    assert done == {1: "x", 2: "none", None: "none"}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_utc_now(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = spark.range(1).select(lake.utc_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 60


@pytest.mark.parametrize("before, after", [(4, 16), (16, 4), (2, 3)])
def test_numbers_do_not_depend_on_how_a_scan_is_cut(spark, tmp_path, before, after):
    """Splits planned differently between the call and the action."""
    path = tmp_path / "long.csv"
    path.write_text("n,pad\n" + "".join(f"{i},{'x' * 50}\n" for i in range(8000)))
    spark.conf.set("spark.sql.files.openCostInBytes", 1000)
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
        numbered = source_ordinal(with_split(scan_listing_csv(spark, str(path))))
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", after)
        spark.conf.set("spark.sql.files.maxPartitionBytes", 30_000 * after)
        got = numbered.collect()
    finally:
        for name in ("leafNodeDefaultParallelism", "files.maxPartitionBytes", "files.openCostInBytes"):
            spark.conf.unset(f"spark.sql.{name}")
    assert sorted((r._ordinal, int(r.n)) for r in got) == [(i, i) for i in range(8000)]


def test_several_csv_files_are_numbered_in_path_order(spark, tmp_path):
    expected = 0
    for part, size in enumerate([300, 5, 900]):
        lines = "".join(f"{i},{'x' * 30}\n" for i in range(expected, expected + size))
        (tmp_path / f"part-{part}.csv").write_text("n,pad\n" + lines)
        expected += size
    got = source_ordinal(with_split(scan_listing_csv(spark, str(tmp_path)))).collect()
    assert sorted((r._ordinal, int(r.n)) for r in got) == [(i, i) for i in range(expected)]

