import glob
import re
import uuid
from datetime import datetime, timedelta

from plans import metadata, plan
from pyspark.sql import functions as F

from tideline.catalog.layouts import bucketed_customers, ordered_files
from tideline.operators.apply import record_fields
from tideline.sinks.buckets import LITERALS, BucketedTable, apply_to_buckets
from tideline.sources.logs import LOG_SCHEMA, read_files, stream_files
from tideline.sources.skipping import FileRanges
from tideline.specs import ApplySpec, Progress, TableSpec
from tideline.streaming.stateful import late, once, read_fold, read_on_time, stream_fold, stream_on_time

T0 = datetime(2024, 1, 1)
RECORDS = "id string, rec map<string,string>"


def above_scan(lines):
    """The operators above the first scan of files, the ones its rows go through."""

    def depth(line):
        return next(i for i, c in enumerate(line) if c.isalnum())

    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    found, edge = [], depth(lines[at])
    for line in reversed([x for x in lines[:at] if any(map(str.isalnum, x))]):
        if depth(line) < edge:
            edge = depth(line)
            found.append(line.strip(" :+-*()0123456789").split(" ")[0])
    return found


def messages(spark, *rows):
    """(partition, offset, hours, value)"""
    return spark.createDataFrame([("t", p, o, T0 + timedelta(hours=h), v) for p, o, h, v in rows], LOG_SCHEMA).coalesce(1)


def test_a_few_ids_open_their_buckets_only(spark, sample):
    target = bucketed_customers(spark, sample)
    named = spark.createDataFrame([("1",), ("22",), ("22",), (None,), ("no such",)], "id string")
    read = target.holding(named).select("id", F.input_file_name().alias("file")).collect()
    assert sorted(r.id for r in read) == ["1", "22"] and len({r.file for r in read}) <= 2
    # Spark shows the choice of buckets only where it reads by bucket; it makes the choice either way
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(setting, "false")
    try:
        shown = metadata(target.holding(named))
    finally:
        spark.conf.unset(setting)
    chosen, every = map(int, re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", shown).groups())
    assert chosen <= 3 < every


def test_many_ids_are_joined_without_moving_the_table(spark, sample):
    target = bucketed_customers(spark, sample)
    named = spark.range(LITERALS + 500).select((F.col("id") + 1).cast("string").alias("id"))
    rows = target.holding(named)
    assert rows.count() == target.read().where(F.col("id").cast("int").between(1, LITERALS + 500)).count()
    changed = target.holding(named).withColumn("rec", F.create_map(F.lit("a"), F.lit("b")))
    for df in (rows, target.after(rows)):
        assert "Exchange" not in above_scan(plan(df).splitlines())
    assert "Bucketed: true" in metadata(rows)
    after = target.after(changed)
    assert after.count() == target.read().count()
    assert after.where(F.col("rec")["a"] == "b").count() == rows.count()


def test_a_batch_applied_to_buckets(spark):
    target = BucketedTable(spark, f"t_{uuid.uuid4().hex}", 8)
    from tideline.session import scratch_root

    held = spark.createDataFrame([("1", {"a": "1"}), ("2", {"a": "2"}), ("3", None)], RECORDS)
    target.create(held, f"{scratch_root(spark)}/{target.name}")
    log = messages(
        spark,
        (0, 0, 0, '{"sys_id":"1","a":null,"b":"x"}'),
        (0, 1, 1, '{"sys_id":"1","b":"y"}'),
        (0, 2, 2, '{"sys_id":"9","a":"lost"}'),
        (0, 3, 3, '{"new":"row"}'),
        (0, 3, 3, '{"new":"row"}'),
        (0, 4, 4, "no json"),
    )
    changed, failed = apply_to_buckets(log, target, ApplySpec("t"))
    got = {r.id: r.rec for r in changed.collect()}
    assert got.pop("1") == {"a": None, "b": "y"} and list(got.values()) == [{"new": "row"}]
    assert sorted(r.offset for r in failed.collect()) == [2, 4]
    after = {r.id: r.rec for r in target.after(changed).collect()}
    assert after["2"] == {"a": "2"} and after["3"] is None and len(after) == 4
    following = BucketedTable(spark, f"t_{uuid.uuid4().hex}", 8)
    following.create(target.after(changed), f"{scratch_root(spark)}/{following.name}")
    replayed, _ = apply_to_buckets(log, following, ApplySpec("t"))
    assert [r.id for r in replayed.collect()] == ["1"]
    nothing, none = apply_to_buckets(log.limit(0), target, ApplySpec("t"))
    assert nothing.collect() == [] and none.collect() == []


def test_a_pull_opens_only_files_that_can_hold_due_rows(spark, sample):
    ranges = ordered_files(spark, sample)
    progress, now = Progress(datetime(1997, 5, 28), "1"), datetime(1998, 1, 1)
    due = ranges.due_files(progress, now)
    assert 0 < len(due) < 6
    assert len(ranges.pull(progress, now=now).inputFiles()) == len(due)
    assert ranges.due_files(Progress(datetime(2050, 1, 1), ""), datetime(2051, 1, 1)) == []
    assert ranges.pull(Progress(datetime(2050, 1, 1), ""), now=datetime(2051, 1, 1)).collect() == []


def test_ranges_of_new_and_rewritten_files(spark, folder):
    spec, rows = TableSpec("t", "ts", "id"), "id string, ts timestamp_ntz"

    def write(name, *days):
        data = [(str(d), None if d is None else T0 + timedelta(days=d)) for d in days]
        spark.createDataFrame(data, rows).coalesce(1).write.mode("overwrite").parquet(f"{folder}/a table/{name}")

    write("x", 1, 2)
    write("y", 11, None)
    ranges = FileRanges(spark, f"{folder}/a table", spec, f"{folder}/ranges")

    def pulled(first, last):
        got = ranges.pull(Progress(T0 + timedelta(days=first), ""), now=T0 + timedelta(days=last)).collect()
        return sorted(r.id for r in got)

    assert pulled(0, 5) == ["1", "2"], "files not known yet are read"
    assert ranges.refresh() == 2 and ranges.refresh() == 0
    assert len(ranges.due_files(Progress(T0, ""), T0 + timedelta(days=5))) == 1
    assert pulled(0, 5) == ["1", "2"] and pulled(5, 20) == ["11"] and pulled(2, 12) == ["11", "2"]
    write("x", 15)
    assert pulled(5, 20) == ["11", "15"]
    assert ranges.refresh() == 1
    assert pulled(5, 20) == ["11", "15"] and pulled(0, 5) == []


def test_a_running_fold_follows_later_batches_and_restarts(spark, folder):
    def run():
        stream_fold(stream_files(spark, f"{folder}/log", 1), f"{folder}/fold", f"{folder}/c", id_field="sys_id").awaitTermination()
        return {(r.id, r.field): r.val for r in record_fields(read_fold(spark, f"{folder}/fold")).collect()}

    messages(spark, (0, 0, 5, '{"sys_id":"1","a":"new","b":"1"}'), (0, 1, 6, '{"x":1}')).write.mode("append").parquet(f"{folder}/log")
    assert run() == {("1", "a"): "new", ("1", "b"): "1"}
    messages(spark, (1, 0, 1, '{"sys_id":"1","a":"old","c":null}'), (1, 1, 7, '{"sys_id":"1","b":null}')).write.mode("append").parquet(f"{folder}/log")
    assert run() == {("1", "a"): "new", ("1", "b"): None, ("1", "c"): None}
    kinds = {name.rsplit(".", 1)[-1] for name in glob.glob(f"{folder}/c/state/0/*/*")}
    assert "changelog" in kinds and "delta" not in kinds, "state is on disk"
    assert "spark.sql.streaming.stateStore.providerClass" not in spark.conf.getAll
    assert run() == {("1", "a"): "new", ("1", "b"): None, ("1", "c"): None}


def test_a_running_fold_looks_up_one_row_a_patch(spark, folder):
    def values(last):
        return ",".join(f'"f{k}":"{last if k < 5 else k}"' for k in range(30))

    rows = [(0, k, k, f'{{"sys_id":"{k % 2}",{values(k)}}}') for k in range(8)]
    rows += [(1, 0, 50, '{"sys_id":"0","f1":null}'), (1, 1, 60, '{"new":"row"}'), (1, 2, 61, "no json"), (1, 3, 62, '{"sys_id":"5"}')]
    messages(spark, *rows).write.mode("append").parquet(f"{folder}/log")
    query = stream_fold(stream_files(spark, f"{folder}/log", 1), f"{folder}/fold", f"{folder}/c", id_field="sys_id")
    query.awaitTermination()
    state = [o for p in query.recentProgress for o in p["stateOperators"]]
    assert 0 < max(o["numRowsTotal"] for o in state) <= 6
    got = {(r.id, r.field): r.val for r in record_fields(read_fold(spark, f"{folder}/fold")).collect()}
    assert len(got) == 60 and {i for i, _ in got} == {"0", "1"}
    assert got["0", "f1"] is None and got["0", "f0"] == "6" and got["1", "f4"] == "7" and got["1", "f29"] == "29"


def test_messages_twice_and_too_late(spark, folder):
    first = messages(spark, (0, 0, 100, "a"), (0, 1, 99, "b"), (0, 0, 100, "a"))
    second = messages(spark, (0, 1, 99, "b"), (0, 2, 98, "c"))
    third = messages(spark, (0, 3, 50, "late"), (0, 4, 97, "d"), (0, 3, 50, "late"))
    for part in (first, second, third):
        part.write.mode("append").parquet(f"{folder}/log")
    query = stream_on_time(stream_files(spark, f"{folder}/log", 1), "10 hours", f"{folder}/once", f"{folder}/c")
    query.awaitTermination()
    on_time = read_on_time(spark, f"{folder}/once", LOG_SCHEMA)
    assert sorted((r.offset, r.timestamp.hour) for r in on_time.collect()) == [(0, 4), (1, 3), (2, 2), (4, 1)]
    assert [r.value for r in late(read_files(spark, f"{folder}/log"), on_time).collect()] == ["late"]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped >= 1
    assert once(stream_files(spark, f"{folder}/log"), "1 hour").columns == ["topic", "partition", "offset", "timestamp", "value"]
