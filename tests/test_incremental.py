import random
from datetime import datetime, timedelta

import pytest
from plans import metadata, plan
from pyspark.sql import functions as F

from tideline.functions.timestamps import is_bad_ts, strict_ts, whole_second
from tideline.operators.incremental import advance, bounds, lag_seconds, late_rows, pull
from tideline.operators import numbering
from tideline.operators.numbering import assign_batches
from tideline.session import stage
from tideline.specs import Progress, TableSpec

SPEC = TableSpec("t", "ts", "id")
SECONDS = TableSpec("t", "ts", "id", precision="second")
T0 = datetime(2024, 3, 15, 10)
NOW = datetime(2024, 3, 15, 10, 30)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.fixture(scope="module")
def boundary(spark):
    rows = [
        ("abc122", T0), ("abc123", T0), ("abc124", T0), (None, T0), ("", T0 + timedelta(minutes=1)),
        ("aaa", T0 + timedelta(minutes=5)), ("zzz", NOW), ("old", T0 - timedelta(seconds=1)),
        ("last", NOW - timedelta(microseconds=1)), ("nots", None),
    ]
    return spark.createDataFrame(rows, "id string, ts timestamp_ntz")


def test_bounded(boundary):
    assert ids(pull(boundary, SPEC, Progress(T0, "abc123"), now=NOW)) == ["aaa", "abc124", "last"]


def test_bounded_without_identifier(boundary):
    found = ids(pull(boundary, SPEC, Progress(T0), now=NOW))
    assert found == ["aaa", "abc122", "abc123", "abc124", "last"]


def test_tied_rows_have_no_upper_bound(boundary):
    assert ids(pull(boundary, SPEC, Progress(T0, "abc123"), now=T0)) == ["abc124"]


def test_unbounded(boundary):
    assert ids(pull(boundary, SPEC, now=NOW)) == ["aaa", "abc122", "abc123", "abc124", "last", "old"]


def test_bounds():
    assert bounds(None, NOW).first is None
    assert bounds(Progress(), NOW, initial_hours=-1).first is None
    assert bounds(None, NOW, initial_hours=24).first == NOW - timedelta(hours=24)
    assert bounds(Progress(T0, "x"), NOW, initial_hours=24).first == T0
    assert bounds(None, NOW, delay_seconds=5).through == NOW - timedelta(seconds=5)
    assert not Progress(datetime(1970, 1, 1, 0, 0, 1), "").is_zero and Progress().is_zero
    assert bounds(Progress(None, "x"), NOW).first == datetime(1970, 1, 1)


def test_limit_takes_the_first_rows(boundary):
    assert ids(pull(boundary, SPEC, now=NOW, limit=2)) == ["abc122", "old"]


def test_projection_keeps_the_position(boundary):
    spec = TableSpec("t", "ts", "id", fields=("id",))
    assert pull(boundary, spec, now=NOW).columns == ["id", "ts"]


def test_text_timestamps(spark):
    rows = [("a", "2024-03-15 10:00:00"), ("b", "2024-03-15 10:00:00"), ("c", "2024-03-15 10:10:00"), ("d", "bad")]
    df = spark.createDataFrame(rows, "id string, ts string")
    assert ids(pull(df, SECONDS, Progress(T0, "a"), now=NOW)) == ["b", "c"]


def random_table(spark, rng, rows, spread_seconds):
    made = [
        (i, T0 + timedelta(microseconds=rng.choice([0, 250000, 500000]), seconds=rng.randrange(spread_seconds)))
        for i in range(rows)
    ]
    rng.shuffle(made)
    return spark.createDataFrame(made, "id bigint, ts timestamp_ntz")


@pytest.mark.parametrize("spec", [SPEC, SECONDS])
@pytest.mark.parametrize("share_of_one_second", [1, 12])
def test_drain_is_whole_and_equals_one_pass(spark, spec, share_of_one_second):
    df = random_table(spark, random.Random(share_of_one_second), 60, share_of_one_second).cache()
    progress, seen, drained = Progress(), [], []
    for batch in range(20):
        rows = pull(df, spec, progress, now=T0 + timedelta(hours=1), limit=7)
        found = [r.id for r in rows.collect()]
        if not found:
            break
        seen += found
        drained += [(i, batch) for i in found]
        row = advance(rows, spec, progress).first()
        progress = Progress(row.ts, row.last_identifier)
    assert sorted(seen) == list(range(60))
    one_pass = assign_batches(df, spec, 7)
    assert sorted(drained) == sorted((r.id, r.batch_no) for r in one_pass.collect())


def test_second_precision_reads_a_split_second_once(spark, sample):
    events = spark.read.parquet(f"{sample}/events.parquet")
    at = Progress(datetime(2024, 1, 1, 8, 30, 5), "126")
    now = datetime(2024, 1, 1, 8, 30, 6)
    spec = TableSpec("events", "ts", "event_id", precision="second")
    assert pull(events, spec, at, now=now).count() == 1
    assert pull(events, TableSpec("events", "ts", "event_id"), at, now=now).count() == 2


def test_advance_modes(spark):
    df = spark.createDataFrame([("new123", "not-a-timestamp")], "id string, ts string")
    before = Progress(datetime(1970, 1, 1, 0, 16, 40), "old")
    atomic = advance(df, SECONDS, before).first()
    assert (atomic.ts, atomic.last_identifier) == (before.ts, "old")
    independent = advance(df, SECONDS, before, mode="independent").first()
    assert (independent.ts, independent.last_identifier) == (before.ts, "new123")
    good = spark.createDataFrame([("xyz789", "2024-06-15 14:30:00")], "id string, ts string")
    row = advance(good, SECONDS).select("*", F.unix_timestamp("ts").alias("epoch")).first()
    assert (row.last_identifier, row.epoch) == ("xyz789", 1718461800)
    with pytest.raises(ValueError):
        advance(good, SECONDS, mode="other")


def test_strict_timestamps(spark):
    texts = ["2024-06-15 14:30:00", "2024-06-15 14:30:00.5", "2024-06-15", "2024-6-15 1:30:00", "2024-06-15 14:30:00\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(strict_ts("t").alias("p"), is_bad_ts("t").alias("b"))
    rows = df.collect()
    assert [r.p for r in rows] == [datetime(2024, 6, 15, 14, 30), None, None, None, None, None]
    assert [r.b for r in rows] == [False, True, True, True, True, False]


def test_whole_seconds_in_any_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = datetime(2024, 3, 10, 2, 30, 0)
        df = spark.createDataFrame([(gap + timedelta(microseconds=250000), str(gap))], "ts timestamp_ntz, text string")
        row = df.select(whole_second(F.col("ts")).alias("t"), strict_ts("text").alias("p")).first()
        assert (row.t, row.p) == (gap, gap)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lag(spark):
    df = spark.createDataFrame([("a", T0), ("a", NOW), ("b", T0)], "table string, ts timestamp_ntz")
    assert {r.table: r.lag_seconds for r in lag_seconds(df, "table", "ts", NOW).collect()} == {"a": 0, "b": 1800}


def test_late_rows(spark, boundary):
    published = boundary.where("id in ('old', 'abc122')")
    assert ids(late_rows(boundary, SPEC, Progress(T0, "abc123"), published)) == ["abc123"]
    only_tied = boundary.where("id = 'abc122'")
    assert ids(late_rows(boundary, SPEC, Progress(T0, "abc123"), only_tied)) == ["abc123", "old"]
    assert ids(late_rows(boundary, SPEC, Progress(T0, "abc123"), only_tied, since=T0)) == ["abc123"]


def test_numbering_with_one_hot_timestamp(spark, monkeypatch):
    """A third of the rows share one timestamp; they still spread over several tasks."""
    df = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).alias("ts")
    ).select("id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    staged = []
    monkeypatch.setattr(numbering, "stage", lambda *args: staged.append(stage(*args)) or staged[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assign_batches(df, SPEC, 100)
        hot = staged[0].where(F.col("ts") == F.lit(T0).cast("timestamp_ntz"))
        assert hot.select(F.input_file_name()).distinct().count() > 1
        rows = numbered.orderBy("ts", "id").select("row_no", "batch_no").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.row_no for r in rows] == list(range(1, 30001))
    assert [r.batch_no for r in rows] == [i // 100 for i in range(30000)]


def test_plan_of_a_limited_pull(spark, sample):
    orders = spark.read.parquet(f"{sample}/orders.parquet")
    spec = TableSpec("orders", "o_orderdate", "o_orderkey", fields=("o_totalprice",))
    df = pull(orders, spec, Progress(datetime(1997, 5, 28), "1"), now=datetime(1998, 1, 1), limit=20)
    text = metadata(df)
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "GreaterThanOrEqual(o_orderdate,1997-05-28T00:00)" in text and "Or(And(EqualTo(o_orderdate" in text
    assert "o_custkey" not in next(line for line in text.splitlines() if "ReadSchema" in line)


def test_plan_of_a_backlog_neither_sorts_nor_shuffles(spark, sample):
    events = spark.read.parquet(f"{sample}/events.parquet")
    spec = TableSpec("events", "ts", "event_id", precision="second")
    text = plan(pull(events, spec, Progress(datetime(2024, 1, 2), "5"), now=datetime(2024, 1, 3)))
    assert "Exchange" not in text and "Sort" not in text and "date_trunc" not in text


def test_partition_column_prunes_directories(spark, folder):
    df = spark.range(10).select("id", F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(cast(id as int))").alias("ts"))
    df.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(folder + "/t")
    spec = TableSpec("t", "ts", "id", partition_col="dt")
    rows = pull(spark.read.parquet(folder + "/t"), spec, Progress(datetime(2024, 1, 8, 13), "1"), now=datetime(2025, 1, 1))
    assert ids(rows) == [8, 9]
    assert "PartitionFilters: [isnotnull(dt#" in metadata(rows).replace("PartitionFilters: [isnotnull(dt), ", "PartitionFilters: [isnotnull(dt#")


def test_numbering_orders_no_table_in_one_partition(spark, sample):
    orders = spark.read.parquet(f"{sample}/orders.parquet")
    text = plan(assign_batches(orders, TableSpec("orders", "o_orderdate", "o_orderkey"), 20, keep=["o_orderkey"]))
    below = text[text.index("SinglePartition"):].splitlines()[1]
    assert "HashAggregate" in below
