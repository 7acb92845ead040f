from datetime import datetime, timedelta

import pytest
from plans import plan
from pyspark.sql import functions as F

from tideline.operators.conflicts import ReviewQueue, agreed, differences, field_clocks, newest_wins, system_of_record
from tideline.operators.messages import readable
from tideline.plans.instances import instance_spec, progress_name, pull_instances
from tideline.sinks.logs import FileLog
from tideline.sources.progress import ProgressStore
from tideline.specs import Progress, PullSettings, TableSpec

T0 = datetime(2024, 1, 1)
FIELDS = "id string, field string, val string, at timestamp_ntz"
RECORDS = "id string, rec map<string,string>"
SPEC = TableSpec("t", "ts", "id")


def records(spark, **rows):
    return spark.createDataFrame(list(rows.items()), RECORDS)


def test_newest_wins_with_ties_nulls_and_repeats(spark):
    left = spark.createDataFrame(
        [("1", "a", "l", T0), ("1", "b", "l", T0), ("1", "c", "l", None), ("2", "a", "l", None), ("3", "a", "x", T0), ("3", "a", "y", T0)], FIELDS
    )
    right = spark.createDataFrame(
        [("1", "a", "r", T0), ("1", "b", None, T0 + timedelta(1)), ("1", "c", "r", T0), ("2", "a", "r", None), ("2", "z", "r", None)], FIELDS
    )
    got = {(r.id, r.field): (r.val, r.side) for r in newest_wins({"left": left, "right": right}).collect()}
    assert got == {
        ("1", "a"): ("l", "left"),
        ("1", "b"): (None, "right"),
        ("1", "c"): ("r", "right"),
        ("2", "a"): ("l", "left"),
        ("2", "z"): ("r", "right"),
        ("3", "a"): ("y", "left"),
    }
    assert newest_wins({"left": left.limit(0), "right": right.limit(0)}).collect() == []
    with pytest.raises(ValueError, match="source"):
        newest_wins({})


def test_field_clocks_keep_the_time_of_the_field_not_of_the_record(spark):
    updates = spark.createDataFrame(
        [("1", {"a": "1", "b": "1"}, T0, 0, 0), ("1", {"b": None}, T0, 0, 1), ("1", {"a": "0"}, T0 - timedelta(1), 9, 9)],
        RECORDS + ", timestamp timestamp_ntz, partition int, offset bigint",
    )
    assert sorted((r.field, r.val, r.at) for r in field_clocks(updates).collect()) == [("a", "1", T0), ("b", None, T0)]


def test_the_system_of_record_tells_null_from_absent(spark):
    first = records(spark, k={"a": None, "o": "first"}, only={})
    second = records(spark, k={"a": "second", "b": "second", "o": "second"})
    got = system_of_record({"first": first, "second": second}, {"o": "second"})
    assert sorted((r.id, r.field, r.val, r.source) for r in got.collect()) == [
        ("k", "a", None, "first"),
        ("k", "b", "second", "second"),
        ("k", "o", "second", "second"),
    ]
    with pytest.raises(ValueError, match="third"):
        system_of_record({"first": first}, {"o": "third"})


def test_records_are_shuffled_before_they_are_cut_into_fields(spark):
    rows = records(spark, k={"a": "1"})
    text = plan(system_of_record({"first": rows, "second": rows}, {"a": "second"}))
    assert text.count("Exchange") == 1 and "field#" not in next(x for x in text.splitlines() if "Exchange" in x)
    updates = rows.selectExpr("id", "rec", "timestamp_ntz'2024-01-01' AS timestamp", "0 AS partition", "0L AS offset")
    exchanges = [x for x in plan(field_clocks(updates)).splitlines() if "Exchange" in x]
    assert len(exchanges) == 2 and not any("field#" in x for x in exchanges)


def versions(spark):
    base = records(spark, k={"same": "1", "mine": "1", "yours": "1", "both": "1", "apart": "1", "gone": "1"})
    ours = records(spark, k={"same": "1", "mine": "2", "yours": "1", "both": "2", "apart": "2", "gone": None, "new": None})
    theirs = records(spark, k={"same": "1", "mine": "1", "yours": None, "both": "2", "apart": "3"}, n={"new": "1"})
    return base, ours, theirs


def test_three_way_states_and_what_they_settle(spark):
    changes = differences(*versions(spark))
    assert {(r.id, r.field): r.state for r in changes.collect()} == {
        ("k", "mine"): "ours",
        ("k", "yours"): "theirs",
        ("k", "both"): "both",
        ("k", "apart"): "conflict",
        ("k", "gone"): "conflict",
        ("k", "new"): "ours",
        ("n", "new"): "theirs",
    }
    assert sorted((r.id, r.field, r.present, r.val) for r in agreed(changes).collect()) == [
        ("k", "both", True, "2"),
        ("k", "mine", True, "2"),
        ("k", "new", True, None),
        ("k", "yours", True, None),
        ("n", "new", True, "1"),
    ]
    removed = differences(records(spark, k={"a": "1"}), records(spark, k={"b": "1"}), records(spark, k={"a": "1"}))
    assert sorted((r.field, r.present) for r in agreed(removed).collect()) == [("a", False), ("b", True)]


def test_review_queue_keeps_one_open_entry_a_conflict(spark, folder):
    queue, changes = ReviewQueue(spark, folder), differences(*versions(spark))

    def state():
        return sorted((r.field, r.run) for r in queue.open().collect())

    queue.add(changes, 0)
    queue.add(changes, 0)
    queue.add(changes, 1)
    assert state() == [("apart", 0), ("gone", 0)]
    queue.close(queue.open().where("field = 'gone'"), 1)
    assert state() == [("apart", 0)]
    queue.add(changes.limit(0), 2)
    queue.add(changes, 3)
    queue.add(changes, 3)
    assert state() == [("apart", 0), ("gone", 3)]


def test_instances_have_keys_and_positions_of_their_own(spark, folder):
    rows = "id string, ts timestamp_ntz"
    east = spark.createDataFrame([("a", T0), ("b", T0 + timedelta(1))], rows)
    west = spark.createDataFrame([("a", T0 + timedelta(2))], rows)
    tables = {"east": east, "west": west, "empty": east.limit(0)}
    store, sink = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    got = pull_instances(tables, SPEC, store, sink, now=T0 + timedelta(9), settings=PullSettings(topic_prefix="p"))
    assert {k: v.rows for k, v in got.items()} == {"east": 2, "west": 1, "empty": 0}
    assert store.get(progress_name("east", SPEC)) == Progress(T0 + timedelta(1), "b")
    assert store.get(progress_name("west", SPEC)) == Progress(T0 + timedelta(2), "a")
    assert store.get(progress_name("empty", SPEC)).is_zero
    keys = [r.key for r in readable(sink.read(spark)).collect()]
    assert len(set(keys)) == 3
    again = pull_instances(tables, SPEC, store, sink, now=T0 + timedelta(9))
    assert {v.rows for v in again.values()} == {0}
    assert instance_spec(TableSpec("t", "ts", "id", key_mode="field_based", key_fields=("x",))).key_fields == ("instance", "x")
    with pytest.raises(ValueError, match="instance"):
        pull_instances({"east": east.withColumn("instance", F.lit(1))}, SPEC, store, sink, now=T0)
