import json

import pytest
from pyspark.sql import functions as F

from tideline.functions.encode import flat_schema, flat_strings, record_json, topic_name
from tideline.functions.keys import composite_key, message_key
from tideline.operators.messages import colocate, contiguous, limit_writers, readable, to_messages
from tideline.operators.reads import strip_links
from tideline.sources.tables import decode_envelopes, read_envelopes
from tideline.specs import TableSpec


@pytest.fixture(scope="module")
def records(spark):
    rows = [("abc123", "ACME", "IT", "1"), (None, None, "IT", "2")]
    return spark.createDataFrame(rows, "sys_id string, company string, assignment_group string, state string")


def keys(df, **kwargs):
    spec = TableSpec("t", "ts", "sys_id", **kwargs)
    return [r.k for r in df.select(message_key(df.schema, spec).alias("k")).collect()]


def test_keys(records):
    assert keys(records) == ["abc123", None]
    assert keys(records, key_mode="round_robin") == [None, None]
    one = keys(records, key_mode="field_based", key_fields=("company", "assignment_group"))
    assert one[0] == "883c5636305b8a2c3a098cbdb5761c073b0a222b4e00ef19faf44f21afc11b51"
    assert one == keys(records, key_mode="field_based", key_fields=("assignment_group", "company"))
    assert len(one[1]) == 64 and one[1] != one[0]
    assert len(keys(records, key_mode="field_based", key_fields=("absent",))[0]) == 64
    assert records.select(composite_key(records.schema, []).alias("k")).first().k is None


def test_a_missing_value_keeps_its_place(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    first, second, third = [r.k for r in df.select(composite_key(df.schema, ["x", "y"]).alias("k")).collect()]
    assert first != second and first == third


@pytest.mark.parametrize("bad", [{"key_mode": "other"}, {"key_mode": "field_based"}, {"precision": "day"}])
def test_spec_is_checked(bad):
    with pytest.raises(ValueError):
        TableSpec("t", "ts", "id", **bad)


def test_spec_needs_its_columns():
    for args in (("", "ts", "id"), ("t", "", "id"), ("t", "ts", "")):
        with pytest.raises(ValueError):
            TableSpec(*args)


def test_json_has_sorted_names_and_nulls(spark):
    df = spark.createDataFrame([("b", None)], "z string, a string")
    assert df.select(record_json(df.schema).alias("v")).first().v == '{"a":null,"z":"b"}'


def test_flat_strings(spark):
    df = spark.sql("SELECT 1 AS a, TRUE AS b, CAST(NULL AS INT) AS c")
    assert df.select(*flat_strings(["c", "a"])).schema.simpleString() == flat_schema(["c", "a"]).simpleString()
    assert all(field.nullable for field in flat_schema(["c", "a"]))
    for build in (flat_strings, flat_schema):
        with pytest.raises(ValueError):
            build([])


def test_topic_names(spark):
    row = spark.range(1).select(
        topic_name("", "p", "incident").alias("a"), topic_name("own", "p", "incident").alias("b")
    ).first()
    assert (row.a, row.b) == ("p.incident", "own")


def test_messages(records):
    spec = TableSpec("incident", "state", "sys_id", topic="own")
    sent = to_messages(records, spec, "p")
    assert sent.schema.simpleString() == (
        "struct<topic:string,key:binary,value:binary,headers:array<struct<key:string,value:binary>>>"
    )
    row = readable(sent).first()
    assert (row.topic, row.key, row.header_key, row.header_value) == ("own", "abc123", "source_table", "incident")
    assert json.loads(row.value) == {"sys_id": "abc123", "company": "ACME", "assignment_group": "IT", "state": "1"}


def _parts(df):
    return df.select("k", "n", F.spark_partition_id().alias("p")).collect()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has one key."""
    n = F.col("id")
    return spark.range(9000).select(F.when(n % 3 == 0, -1).otherwise(n % 50).alias("k"), n.alias("n")).repartition(5)


def test_colocate_keeps_a_key_in_one_partition_in_order(hot):
    seen, order = {}, {}
    for row in _parts(colocate(hot, "k", ["n"], 8)):
        assert seen.setdefault(row.k, row.p) == row.p
        order.setdefault(row.k, []).append(row.n)
    assert all(ns == sorted(ns) for ns in order.values()) and sum(map(len, order.values())) == 9000


def test_contiguous_splits_a_hot_key_in_order(hot):
    rows = _parts(contiguous(hot, "k", ["n"], 8))
    assert [(r.k, r.n) for r in rows] == sorted((r.k, r.n) for r in rows) and len(rows) == 9000
    assert len({r.p for r in rows if r.k == -1}) > 1
    sizes = [sum(r.p == p for r in rows) for p in {r.p for r in rows}]
    assert max(sizes) < 3000


def test_limit_writers(hot):
    assert limit_writers(hot, 3).select(F.spark_partition_id()).distinct().count() == 3


def test_envelopes(spark, folder):
    pages = ['{"result":[{"sys_id":"1","n":2},{"sys_id":"2"}]}', '{"result":[]}', '{"other":1}']
    for i, page in enumerate(pages):
        with open(f"{folder}/{i}.json", "w") as out:
            out.write(page)
    landed = read_envelopes(spark, folder)
    assert sorted(r.record["sys_id"] for r in landed.collect()) == ["1", "2"]
    bodies = spark.createDataFrame([(p,) for p in pages], "body string")
    typed = decode_envelopes(bodies, "body", "struct<sys_id: string, n: int>")
    assert sorted((r.sys_id, r.n) for r in typed.collect()) == [("1", 2), ("2", None)]


def test_links_become_values(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('link', 'u', 'value', 'v') AS who, named_struct('x', 1) AS other")
    assert strip_links(df).first().asDict(True) == {"id": 1, "who": "v", "other": {"x": 1}}
