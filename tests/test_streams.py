import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tideline.operators.messages import readable
from tideline.plans.pull import pull_once, run_all
from tideline.sinks.logs import FileLog, KafkaLog
from tideline.sinks.targets import DeadLetterTable, RecordTable
from tideline.sources.logs import LOG_SCHEMA, kafka_options, read_files, stream_files
from tideline.sources.progress import ProgressStore
from tideline.specs import ApplySpec, Progress, PullSettings, TableSpec
from tideline.streaming.queries import poll_table, stream_apply, stream_publish

T0 = datetime(2024, 1, 1)
NOW = datetime(2024, 1, 2)
SPEC = TableSpec("t", "ts", "id", precision="second")
SETTINGS = PullSettings(topic_prefix="p")
ROWS = "id string, ts timestamp_ntz"


def rows(spark, *idents):
    return spark.createDataFrame([(i, T0 + timedelta(seconds=n)) for n, i in enumerate(idents)], ROWS)


class Broken:
    """A sink that writes and then fails, as long as ``fails`` lasts."""

    def __init__(self, inner, fails):
        self.inner, self.fails, self.batches = inner, fails, []

    def publish(self, messages, batch):
        self.inner.publish(messages, batch)
        self.batches.append(batch)
        if self.fails:
            self.fails -= 1
            raise RuntimeError("lost the acknowledgement")


def published(spark, sink):
    return sorted(r.key for r in readable(sink.read(spark)).collect())


def test_progress_moves_only_after_publishing(spark, folder):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    sink = Broken(log, 1)
    with pytest.raises(RuntimeError):
        pull_once(rows(spark, "a", "b"), SPEC, store, sink, now=NOW, settings=SETTINGS)
    assert store.get("t").is_zero
    result = pull_once(rows(spark, "a", "b", "c"), SPEC, store, sink, now=NOW, settings=SETTINGS)
    assert result.rows == 3 and store.get("t") == Progress(T0 + timedelta(seconds=2), "c")
    assert published(spark, log) == ["a", "b", "c"]
    again = pull_once(rows(spark, "a", "b", "c"), SPEC, store, sink, now=NOW, settings=SETTINGS)
    assert again.rows == 0 and again.progress == result.progress
    pull_once(rows(spark, "a", "b", "c", "d"), SPEC, store, sink, now=NOW, settings=SETTINGS)
    assert published(spark, log) == ["a", "b", "c", "d"]


def test_limited_pulls_drain(spark, folder):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    settings = PullSettings(topic_prefix="p", batch_size=2)
    sizes = [pull_once(rows(spark, *"abcde"), SPEC, store, log, now=NOW, settings=settings).rows for _ in range(4)]
    assert sizes == [2, 2, 1, 0] and published(spark, log) == list("abcde")


@pytest.mark.parametrize("placement", ["colocated", "contiguous"])
def test_placed_pulls_publish_keys_in_order(spark, folder, placement):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    spec = TableSpec("t", "ts", "id", key_mode="field_based", key_fields=("g",))
    made = [(f"{i:03}", T0 + timedelta(seconds=i), f"g{i % 3}") for i in range(99)]
    df = spark.createDataFrame(made, ROWS + ", g string").repartition(6)
    settings = PullSettings(topic_prefix="p", placement=placement)
    assert pull_once(df, spec, store, log, now=NOW, settings=settings).rows == 99
    assert store.get("t").last_identifier == "098"
    order = {}
    for row in readable(log.read(spark)).collect():
        order.setdefault(row.key, []).append(json.loads(row.value)["id"])
    assert len(order) == 3 and all(ids == sorted(ids) and len(ids) == 33 for ids in order.values())


def test_placement_is_checked():
    with pytest.raises(ValueError):
        PullSettings(placement="anywhere")


def test_pulls_side_by_side(spark, folder):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")

    def job(name):
        return lambda: pull_once(
            rows(spark, name), TableSpec(name, "ts", "id"), store, log, now=NOW, settings=SETTINGS
        ).rows

    def broken():
        raise ValueError("no such table")

    results = run_all(spark, {"one": job("one"), "bad": broken, "two": job("two")})
    assert (results["one"], results["two"]) == (1, 1) and isinstance(results["bad"], ValueError)
    assert set(store.snapshot()) == {"one", "two"}


def test_stream_resumes_and_repeats_a_failed_batch(spark, folder):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    sink = Broken(log, 1)

    def run():
        landed = spark.readStream.schema(ROWS).parquet(f"{folder}/in")
        stream_publish(landed, SPEC, store, sink, f"{folder}/cp", settings=SETTINGS).awaitTermination()

    rows(spark, "a", "b", "", None).write.parquet(f"{folder}/in")
    with pytest.raises(StreamingQueryException):
        run()
    assert store.get("t").is_zero
    run()
    assert sink.batches == ["t-0", "t-0"] and published(spark, log) == ["a", "b"]
    run()
    assert sink.batches == ["t-0", "t-0"]
    rows(spark, "c").write.mode("append").parquet(f"{folder}/in")
    run()
    assert sink.batches[-1] == "t-1" and published(spark, log) == ["a", "b", "c"]


def test_older_rows_do_not_move_progress_back(spark, folder):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    ahead = Progress(datetime(2030, 1, 1), "z")
    store.set("t", ahead)
    store.flush()
    rows(spark, "a").write.parquet(f"{folder}/in")
    landed = spark.readStream.schema(ROWS).parquet(f"{folder}/in")
    stream_publish(landed, SPEC, store, log, f"{folder}/cp", settings=SETTINGS).awaitTermination()
    assert published(spark, log) == ["a"] and ProgressStore(spark, f"{folder}/p").get("t") == ahead
    with pytest.raises(ValueError, match="delay_seconds"):
        stream_publish(landed, SPEC, store, log, f"{folder}/cp2", settings=PullSettings(delay_seconds=5))


def test_polling_follows_a_changing_table(spark, folder):
    store, log = ProgressStore(spark, f"{folder}/p"), FileLog(f"{folder}/log")
    rows(spark, "a").write.parquet(f"{folder}/table")
    query = poll_table(
        spark, lambda: spark.read.schema(ROWS).parquet(f"{folder}/table"), SPEC, store, log, f"{folder}/cp",
        settings=SETTINGS, interval="500 milliseconds", clock=lambda: NOW,
    )
    try:
        def wait_for(expected):
            until = time.time() + 60
            while time.time() < until:
                if ProgressStore(spark, f"{folder}/p").get("t").last_identifier == expected:
                    return
                time.sleep(0.5)
            raise AssertionError(f"{expected} was not published")

        wait_for("a")
        rows(spark, "a", "b").where("id = 'b'").write.mode("append").parquet(f"{folder}/table")
        wait_for("b")
    finally:
        query.stop()
    assert published(spark, log) == ["a", "b"]


def land(spark, folder, batch, *values, topic="t"):
    made = [(topic, 0, batch * 100 + i, T0 + timedelta(seconds=batch), v) for i, v in enumerate(values)]
    spark.createDataFrame(made, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/log")


def start_apply(spark, folder, **kwargs):
    target, dead = RecordTable(spark, f"{folder}/target"), DeadLetterTable(f"{folder}/dead")
    spec = ApplySpec("x", commit_on_partial_failure=kwargs.pop("commit", True))
    log = stream_files(spark, f"{folder}/log", files_per_trigger=1)
    stream_apply(log, "t", target, spec, f"{folder}/cp", dead=dead, clock=lambda: NOW).awaitTermination()
    return target, dead


def test_stream_apply_in_batches(spark, folder):
    RecordTable(spark, f"{folder}/target").create(
        spark.createDataFrame([("a", {"s": "0"})], "id string, rec map<string,string>")
    )
    land(spark, folder, 0, '{"sys_id":"a","s":"1","n":"x"}', "{bad")
    land(spark, folder, 0, '{"sys_id":"a","s":"other"}', topic="other")
    land(spark, folder, 1, '{"sys_id":"a","s":"2"}', '{"sys_id":"q"}')
    target, dead = start_apply(spark, folder)
    assert {r.id: r.rec for r in target.read().collect()} == {"a": {"s": "2", "n": "x"}}
    assert dead.read(spark).count() == 2 and read_files(spark, f"{folder}/log").count() == 5
    land(spark, folder, 2, '{"sys_id":"a","s":null}')
    target, _ = start_apply(spark, folder)
    assert {r.id: r.rec for r in target.read().collect()} == {"a": {"s": None, "n": "x"}}


def test_stream_apply_repeats_a_batch_that_may_not_fail(spark, folder):
    land(spark, folder, 0, '{"n":"1"}', "{bad")
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            start_apply(spark, folder, commit=False)
    target, dead = start_apply(spark, folder, commit=True)
    assert target.read().count() == 1 and dead.read(spark).count() == 1


def test_kafka_options():
    options = kafka_options("h:9092", ["a", "b"], **{"kafka.security.protocol": "SASL_SSL"})
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "a,b"
    assert kafka_options("h:9092", ["a"], 100)["maxOffsetsPerTrigger"] == "100" and options["kafka.security.protocol"] == "SASL_SSL"
    assert "maxOffsetsPerTrigger" not in kafka_options("h:9092", ["a"], None)
    with pytest.raises(ValueError):
        kafka_options("h:9092", [])
    assert KafkaLog("h:9092").options["kafka.acks"] == "all"


def _places(log, spark):
    rows = log.read(spark).select("topic", "partition", "offset", "timestamp", "batch", F.col("value").cast("string").alias("value"))
    return sorted(tuple(r) for r in rows.collect())


def _messages(spark, values, topic="t"):
    rows = [(topic, None if v.startswith("-") else f"k{v[-1]}".encode(), v.encode(), None) for v in values]
    return spark.createDataFrame(rows, "topic string, key binary, value binary, headers array<struct<key: string, value: binary>>")


def test_a_batch_published_again_keeps_its_places(spark, folder):
    clock = iter(datetime(2024, 1, d) for d in range(1, 20))
    log = FileLog(f"{folder}/log", partitions=3, clock=lambda: next(clock))
    log.publish(_messages(spark, [f"a{k}" for k in range(20)] + ["-n"]), "one")
    first = _places(log, spark)
    by_partition = {}
    for _, p, o, *_ in first:
        by_partition.setdefault(p, []).append(o)
    assert all(sorted(o) == list(range(len(o))) for o in by_partition.values()) and len(first) == 21
    log.publish(_messages(spark, [f"a{k}" for k in range(20)] + ["-n"]), "one")
    assert _places(log, spark) == first, "places and times"
    log.publish(_messages(spark, [f"b{k}" for k in range(9)]), "two")
    both = _places(log, spark)
    assert [r for r in both if r[4] == "one"] == first
    assert len({r[:3] for r in both}) == len(both) == 30
    log.publish(_messages(spark, [f"a{k}" for k in range(20)] + ["-n"]), "one")
    assert _places(log, spark) == both, "also with a batch behind it"
    log.publish(_messages(spark, [f"a{k}" for k in range(30)]), "one")
    grown = _places(log, spark)
    assert len({r[:3] for r in grown}) == len(grown) == 39, "grown into no other's places"
    assert [r for r in grown if r[4] == "two"] == [r for r in both if r[4] == "two"]


def test_reservations_do_not_grow_with_the_log(spark, folder):
    from tideline.sinks import logs

    log = FileLog(f"{folder}/log", partitions=1)
    for k in range(logs.MARK_SLOTS + 3):
        log.publish(_messages(spark, [f"v{k}", f"w{k}"]), f"batch {k}")
    log.publish(_messages(spark, ["x"], "other"), "batch 0")
    assert spark.read.schema(logs.MARK_SCHEMA).parquet(log.marks("t")).count() == logs.MARK_SLOTS
    offsets = {t: sorted(o for x, _, o, *_ in _places(log, spark) if x == t) for t in ("t", "other")}
    assert offsets == {"t": list(range(2 * logs.MARK_SLOTS + 6)), "other": [0]}


def test_an_empty_batch_takes_no_places(spark, folder):
    log = FileLog(f"{folder}/log")
    log.publish(_messages(spark, []), "none")
    log.publish(_messages(spark, ["a"]), "one")
    assert [r[2] for r in _places(log, spark)] == [0]
