import random
from datetime import datetime

import pytest
from plans import plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.payload import flat_object, parsed_record, record_id
from tideline.operators.apply import (
    dead_letters,
    fold_patches,
    from_records,
    merge_columns,
    merge_patches,
    parse_log,
    route_topics,
    to_records,
    typed_updates,
)
from tideline.plans.apply import PartialFailure, apply_batch, apply_log, missing_ids
from tideline.session import small_side
from tideline.sinks.targets import DeadLetterTable, ExternalTable, RecordTable
from tideline.specs import ApplySpec

LOG = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string"
NOW = datetime(2024, 1, 1)

PAYLOADS = [
    ('{"sys_id":"abc","state":"1"}', "update", "abc"),
    ('{"state":"1"}', "insert", None),
    ('{"sys_id":"","state":"1"}', "insert", None),
    ('{"sys_id":12345}', "insert", None),
    ('{"sys_id":"12345"}', "update", "12345"),
    ('{"sys_id":"-1.5E7"}', "update", "-1.5E7"),
    ('{"sys_id":-1.5E30}', "insert", None),
    ('{"sys_id":true}', "insert", None),
    ('{"sys_id":"true"}', "update", "true"),
    ('{"sys_id":["a"]}', "insert", None),
    ('{"sys_id":"[\\"a\\"]"}', "update", '["a"]'),
    ('{"sys_id":{"a":1}}', "insert", None),
    ('{"sys_id":null}', "insert", None),
    ('{"a":{"sys_id":"x"}}', "insert", None),
    ('{"SYS_ID":"x"}', "insert", None),
    ('{"sys_id":5,"sys_id":"x"}', "update", "x"),
    ('{"sys_id":"x","sys_id":5}', "insert", None),
    ("{}", "insert", None),
    (' \n{"sys_id":"p\\n"} \n', "update", "p\n"),
    ("{bad", "reject", None),
    ("[1]", "reject", None),
    ('[{"sys_id":"a"}]', "reject", None),
    ("", "reject", None),
    (None, "reject", None),
    ("null", "reject", None),
    ("12", "reject", None),
    ('"text"', "reject", None),
    ('{"a":1} x', "reject", None),
    ("{'a':1}", "reject", None),
    ('{"a":1} {"b":2}', "reject", None),
    ('{"a":1},{"b":2}', "reject", None),
    ('{"a":1}] [{"b":1}', "reject", None),
    ('{"a":1}} {"b":{"c":1}', "reject", None),
    ('{"a":1},"q":{"b":2}', "reject", None),
    ('{"a":1},"r":{"b":2}', "reject", None),
    ('{"a":1}]', "reject", None),
    ('{"a":1}}', "reject", None),
    ("}", "reject", None),
    ('{"a":NaN}', "reject", None),
    ('{"a":1,}', "reject", None),
    ('{"a":"\t"}', "reject", None),
]


def log_of(spark, values, topic="t"):
    rows = [(topic, 0, i, NOW, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LOG)


def recs(df):
    return {r.id: dict(r.rec) for r in df.collect()}


def test_routes(spark):
    parsed = parse_log(log_of(spark, [p for p, _, _ in PAYLOADS]), "sys_id").orderBy("offset").collect()
    assert [(r.value, r.operation, r.id) for r in parsed] == PAYLOADS


def test_the_last_of_repeated_fields_counts(spark):
    row = parse_log(log_of(spark, ['{"a":"1","b":"2","a":"3","a":null}']), "sys_id").selectExpr("size(rec) AS n", "rec").first()
    assert (row.n, row.rec) == (2, {"a": None, "b": "2"})


def test_rejects_tell_why_with_an_excerpt(spark):
    text = "é" * 300
    row = parse_log(log_of(spark, [text]), "sys_id").first()
    assert row.error == f"deserializing record: not a JSON object (raw: {text[:200]})"
    letter = dead_letters(parse_log(log_of(spark, [text]), "sys_id"), "incident", NOW).first()
    assert letter.original_payload == text
    assert (letter.timestamp, letter.topic, letter.table) == ("2024-01-01T00:00:00Z", "t", "incident")


PATCHES = [("a", 0, {"state": "1", "x": "p"}), ("a", 1, {"state": "2"}), ("b", 2, {"state": "9", "y": None})]


def patches_of(spark, rows):
    return spark.createDataFrame(rows, "id string, offset bigint, rec map<string,string>")


@pytest.mark.parametrize("fields", [(), ("state", "x", "y")])
def test_fold(spark, fields):
    folded = recs(fold_patches(patches_of(spark, PATCHES), order=("offset",), fields=fields))
    assert folded == {"a": {"state": "2", "x": "p"}, "b": {"state": "9", "y": None}}


def test_fields_left_out_are_folded_too(spark):
    whole = recs(fold_patches(patches_of(spark, PATCHES), order=("offset",)))
    for fields in (["state"], ["absent"]):
        assert recs(fold_patches(patches_of(spark, PATCHES), order=("offset",), fields=fields)) == whole


@pytest.mark.parametrize("fields", [(), ("f0", "f1", "f2", "f3")])
def test_fold_of_a_hot_id_equals_one_by_one(spark, fields):
    """A third of the patches is for one id; the input partitioning does not matter."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        ident = "hot" if i % 3 == 0 else f"id{rng.randrange(400)}"
        rows.append((ident, i, {f"f{j}": rng.choice(["x", "y", None]) for j in range(4) if rng.random() < 0.5}))
    expected = {}
    for ident, _, rec in rows:
        expected.setdefault(ident, {}).update(rec)
    expected = {k: v for k, v in expected.items() if v or fields}
    for parts in (1, 7):
        df = patches_of(spark, rng.sample(rows, len(rows))).repartition(parts)
        assert recs(fold_patches(df, order=("offset",), fields=fields)) == expected


def test_fold_combines_before_it_shuffles(spark):
    for fields in ((), ("state",)):
        text = plan(fold_patches(patches_of(spark, PATCHES), order=("offset",), fields=fields))
        last = text.rindex("Exchange hashpartitioning")
        assert "partial_max_by" in text[last:]


def test_fold_shuffles_patches_by_id_and_never_fields(spark):
    for fields in ((), ("state",)):
        text = plan(fold_patches(patches_of(spark, PATCHES), order=("offset",), fields=fields))
        exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 2 and not any("field#" in line for line in exchanges)


def test_a_look_at_a_flat_object_equals_the_parse(spark):
    flat = ["{}", '{"sys_id":"1"}', '{"sys_id":"12","a":null,"b":"x y"}', '{"sys_id":"true","sys_id":"2"}', '{"a":"\u00e9, {"}']
    other = ['{"sys_id":1}', '{"sys_id":"1"} x', '{"sys_id":"1"}{"a":"2"}', '{"sys_id":"1",}', '{"a":"\\n"}', '{"a": "1"}', "null", "", None, '{"a":"1"}\n', '{"a":[]}']
    rows = log_of(spark, [*flat, *other, '{"a":"' + "x" * 2000 + '"}'])
    got = {r["value"]: r for r in parse_log(rows.withColumn("flat", flat_object("value")), "sys_id").collect()}
    assert [v for v in got if got[v]["flat"]] == flat
    plain = rows.withColumn("_raw", parsed_record("value")).withColumn("id", record_id("value", "_raw", "sys_id"))
    for r in plain.collect():
        assert got[r["value"]]["operation"] == ("reject" if r["_raw"] is None else "update" if r["id"] else "insert")
        assert "sys_id\":\"true" in (r["value"] or "") or got[r["value"]]["id"] == r["id"]


def test_merge(spark):
    target = spark.createDataFrame([("a", {"state": "1", "x": "keep"}), ("c", {"s": None})], "id string, rec map<string,string>")
    patch = spark.createDataFrame([("a", {"state": "2"}), ("zz", {"state": "3"})], "id string, rec map<string,string>")
    assert recs(merge_patches(target, patch)) == {"a": {"state": "2", "x": "keep"}, "c": {"s": None}}


def test_merge_typed(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "old", 6)], "id int, name string, n int")
    patch = spark.createDataFrame([("1", {"n": "7", "name": None})], "id string, rec map<string,string>")
    assert sorted(map(tuple, merge_columns(target, "id", patch).collect())) == [(1, None, 7), (2, "old", 6)]
    again = from_records(to_records(target, "id"), target.schema, "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, target.collect()))


def test_unmapped_topics_are_not_read(spark):
    log = log_of(spark, ["{}"], "a").union(log_of(spark, ["{}"], "b"))
    routes = spark.createDataFrame([("a", "incident")], "topic string, table string")
    assert [(r.topic, r.table) for r in route_topics(log, routes).collect()] == [("a", "incident")]


MIXED = [
    '{"sys_id":"a","state":"2"}',
    '{"sys_id":"nobody","state":"2"}',
    '{"name":"new"}',
    "{bad",
    '{"sys_id":"1f21795dc1ebbf9d2104882c481e41d5","name":"changed"}',
    '{"name":"first"}',
]


@pytest.fixture
def target_rows(spark):
    return spark.createDataFrame([("a", {"state": "1", "x": "keep"})], "id string, rec map<string,string>")


def test_apply_counts_new_rows_as_known(spark, target_rows):
    rows, failed = apply_log(log_of(spark, MIXED), target_rows, ApplySpec("incident"))
    found = recs(rows)
    assert found["1f21795dc1ebbf9d2104882c481e41d5"] == {"name": "changed"}
    assert found["a"] == {"state": "2", "x": "keep"} and len(found) == 3
    assert sorted((r.offset, r.error.split(":")[0]) for r in failed.collect()) == [
        (1, "updating record nobody"),
        (3, "deserializing record"),
    ]


def _setup(spark, folder, target_rows):
    target, dead = RecordTable(spark, f"{folder}/target"), DeadLetterTable(f"{folder}/dead")
    target.create(target_rows)
    return target, dead


def test_replay_changes_nothing(spark, folder, target_rows):
    target, dead = _setup(spark, folder, target_rows)
    spec = ApplySpec("incident", fields=("state", "name", "x"))
    for _ in range(2):
        failures = apply_batch(log_of(spark, MIXED), 0, target, spec, now=NOW, dead=dead, metrics_path=f"{folder}/counts")
        assert failures == 2
        found = recs(target.read())
        assert found["1f21795dc1ebbf9d2104882c481e41d5"] == {"name": "changed"}
        assert len(found) == 3 and dead.read(spark).count() == 2
    counts = {(r.metric, r.label): r.value for r in spark.read.parquet(f"{folder}/counts").collect()}
    assert counts == {
        ("sink_records_total", "update"): 2,
        ("sink_records_total", "insert"): 2,
        ("sink_errors_total", "write"): 2,
    }


def test_later_batches_and_compaction(spark, folder, target_rows):
    target, _ = _setup(spark, folder, target_rows)
    spec = ApplySpec("incident")
    for batch, value in enumerate(['{"sys_id":"a","state":"5"}', '{"sys_id":"a","state":"6","y":null}', '{"n":"1"}']):
        apply_batch(log_of(spark, [value]), batch, target, spec, now=NOW)
    before = recs(target.read())
    assert before["a"] == {"state": "6", "y": None, "x": "keep"} and len(before) == 2
    assert recs(target.read(before=1))["a"] == {"state": "5", "x": "keep"}
    target.compact(1)
    assert target.compacted == 1 and recs(target.read()) == before
    target.compact(2)
    assert recs(RecordTable(spark, f"{folder}/target").read()) == before


def test_sources_share_a_target(spark, folder, target_rows):
    target, dead = _setup(spark, folder, target_rows)
    spec = ApplySpec("incident")
    for hour, source in enumerate(("one", "two")):
        log = log_of(spark, ['{"sys_id":"a","%s":"1"}' % source, '{"n":"1"}', "{bad"], source)
        for _ in range(2):
            apply_batch(log, 0, target, spec, now=NOW.replace(hour=hour), dead=dead, source=source)
    before = recs(target.read())
    assert before["a"] == {"state": "1", "x": "keep", "one": "1", "two": "1"} and len(before) == 3
    assert sorted(r.topic for r in dead.read(spark).collect()) == ["one", "two"]
    with pytest.raises(ValueError, match="applied earlier"):
        target.compact({"two": 0})
    target.compact({"one": 0})
    assert recs(target.read()) == before
    target.compact(0)
    assert target.included == {"one": 0, "two": 0} and recs(target.read()) == before


def test_compacted_batches_are_refused_and_new_checkpoints_kept(spark, folder, target_rows):
    target, _ = _setup(spark, folder, target_rows)
    spec = ApplySpec("incident")
    log = log_of(spark, ['{"n":"1"}', '{"sys_id":"a","state":"7"}'])
    apply_batch(log, 1, target, spec, now=NOW, source="first")
    target.compact(1)
    before = recs(target.read())
    with pytest.raises(ValueError, match="compacted"):
        apply_batch(log, 0, target, spec, now=NOW, source="first")
    apply_batch(log, 0, target, spec, now=NOW.replace(hour=1), source="second")
    assert target.read().count() == len(before) == 2 and recs(target.read()) == before
    apply_batch(log_of(spark, ['{"sys_id":"a","state":"8"}']), 1, target, spec, now=NOW.replace(hour=2), source="second")
    assert recs(target.read())["a"]["state"] == "8"


def test_partial_failure_policy(spark, folder, target_rows):
    target, dead = _setup(spark, folder, target_rows)
    spec = ApplySpec("incident", commit_on_partial_failure=False)
    for _ in range(2):
        with pytest.raises(PartialFailure):
            apply_batch(log_of(spark, MIXED), 0, target, spec, now=NOW, dead=dead)
    assert len(recs(target.read())) == 3 and dead.read(spark).count() == 2
    assert apply_batch(log_of(spark, MIXED[:1]), 1, target, spec, now=NOW) == 0


def test_without_dead_letters_failures_are_counted_only(spark, folder, target_rows):
    target, _ = _setup(spark, folder, target_rows)
    assert apply_batch(log_of(spark, MIXED), 0, target, ApplySpec("incident"), now=NOW) == 2


def test_external_target(spark, folder, target_rows):
    def send(rows):
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex + ".sent"), "w") as out:
            out.writelines(f"{r.kind} {r.id}\n" for r in rows)

    import glob

    external = ExternalTable(lambda: target_rows, send, writers=2)
    apply_batch(log_of(spark, MIXED), 0, external, ApplySpec("incident"), now=NOW)
    files = glob.glob(f"{folder}/*.sent")
    lines = [line for f in files for line in open(f)]
    assert len(files) == 2 and sorted(line.split()[0] for line in lines) == ["insert", "insert", "patch", "patch"]


def test_a_batch_looks_at_its_target_once(spark):
    looks = spark.sparkContext.accumulator(0)

    def seen(row):
        looks.add(1)
        return row

    def known():
        ids = [("a",), ("b",), ("1f21795dc1ebbf9d2104882c481e41d5",)]
        return spark.createDataFrame(spark.sparkContext.parallelize(ids, 1).map(seen), "id string")

    external = ExternalTable(known, lambda rows: None, writers=1)
    assert apply_batch(log_of(spark, MIXED), 0, external, ApplySpec("incident"), now=NOW) == 2
    assert looks.value == 3


def test_rows_held_and_new_ones_in_one_batch(spark, folder, target_rows):
    target, _ = _setup(spark, folder, target_rows)
    spec = ApplySpec("incident")
    apply_batch(log_of(spark, ['{"n":"1"}']), 0, target, spec, now=NOW, source="first")
    again = log_of(spark, ['{"n":"1"}', '{"n":"2"}', '{"sys_id":"a","state":"9"}', "{bad"])
    assert apply_batch(again.unionByName(again), 0, target, spec, now=NOW.replace(hour=1), source="second") == 2
    rows = sorted(str(sorted(r.rec.items())) for r in target.read().collect())
    assert rows == ["[('n', '1')]", "[('n', '2')]", "[('n', '2')]", "[('state', '9'), ('x', 'keep')]"]


def test_insert_ids(spark):
    log = spark.createDataFrame([("t", 0, 5, NOW, '{"a":"1"}')], LOG)
    rows, _ = apply_log(log, spark.createDataFrame([], "id string, rec map<string,string>"), ApplySpec("x"))
    assert recs(rows) == {"1f21795dc1ebbf9d2104882c481e41d5": {"a": "1"}}


def test_hot_unknown_id_is_rejected_whole(spark, target_rows):
    values = ['{"sys_id":"ghost","state":"1"}'] * 500 + ['{"sys_id":"a","state":"%d"}' % i for i in range(500)]
    rows, failed = apply_log(log_of(spark, values).repartition(8), target_rows, ApplySpec("x"))
    assert failed.count() == 500 and recs(rows)["a"]["state"] == "499"


def test_a_small_batch_does_not_shuffle_the_target(spark, folder):
    """The ids of a large target are scanned in place when a batch names few."""
    spark.range(100000).selectExpr("cast(id as string) AS id").write.parquet(f"{folder}/ids")
    parsed, held = parse_log(log_of(spark, MIXED), "sys_id").persist(), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unknown = missing_ids(parsed, spark.read.parquet(f"{folder}/ids"), held)
        text = plan(unknown)
        assert "SortMergeJoin" not in text.split("FileScan parquet")[0].split("LeftAnti")[-1]
        assert sorted(r.id for r in unknown.collect()) == ["a", "nobody"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for df in (parsed, *held):
            df.unpersist()


def test_small_side_is_measured(spark):
    df = spark.range(100).selectExpr("cast(id as string) AS id")
    marked = small_side(df, "id")._jdf.queryExecution().logical().toString()
    assert "broadcast" in marked
    assert "broadcast" not in small_side(df, "id", 100)._jdf.queryExecution().logical().toString()


def test_folding_needs_no_python(spark):
    text = plan(fold_patches(parse_log(log_of(spark, ["{}"]), "sys_id")))
    assert "Python" not in text


def test_named_fields_are_folded_in_one_pass(spark, folder):
    """One scan, the parse of the other form and no join, whatever the fields; the same result."""
    spark.createDataFrame([(k, f'{{"sys_id":"{k % 3}","a":"{k}","b":null,"c":"x{k}"}}') for k in range(20)], "offset bigint, value string").write.parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log").select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp_ntz").alias("timestamp"), "value")
    updates = parse_log(log, "sys_id")

    def counted(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("FileScan"), plan.count("from_json"), plan.count("Join")

    plain = fold_patches(updates)
    for fields in (("a",), ("a", "b"), ("a", "b", "c"), ("none", "b")):
        named = fold_patches(updates, fields=fields)
        assert counted(named)[0] == 1 and counted(named)[2] == 0
        assert counted(named)[1] <= counted(plain)[1]
        assert {r["id"]: r["rec"] for r in named.collect()} == {r["id"]: r["rec"] for r in plain.collect()}


def test_values_that_a_type_cannot_hold_are_named(spark):
    schema = T.StructType.fromDDL("k bigint, price double, day date, note string, flag boolean")
    rows = [
        ("1", {"price": "1.5", "day": "2024-02-30"}), ("2", {"price": "many", "flag": "maybe", "note": "n"}),
        ("3", {"price": None, "day": "2024-02-29", "other": "x"}), ("4", {}), ("5", {"k": "not a key"}), ("6", {"note": ""}),
    ]
    updates = spark.createDataFrame(rows, "id string, rec map<string,string>")
    errors = {r["id"]: r["error"] for r in typed_updates(updates, schema, "k").collect()}
    start = "updating record {}: no value of the column's type: "
    assert errors == {
        "1": start.format(1) + "day = 2024-02-30", "2": start.format(2) + "price = many, flag = maybe", "3": None, "4": None, "5": None, "6": None,
    }
