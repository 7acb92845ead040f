"""Keys, values, topics and placement of outgoing messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.catalog.base import Query, table
from tideline.catalog.filters import STATES, _states
from tideline.functions.encode import flat_strings, record_json, topic_name
from tideline.functions.keys import composite_key, identifier_key, no_key
from tideline.operators.messages import colocate, contiguous, readable, to_messages
from tideline.specs import TableSpec

ORDERS = TableSpec("orders", "o_orderdate", "o_orderkey", precision="second")
EVENTS = TableSpec("events", "ts", "event_id", key_mode="field_based", key_fields=("user_id", "event_type"))


def _keyed(name, ident, make):
    def run(spark, folder):
        df = table(spark, folder, name)
        return df.select(ident, make(df.schema).alias("key"))

    return run


def _nullable(spark, folder):
    df = _states(spark, folder)
    return df.select("event_id", composite_key(df.schema, ["state", "event_id", "absent"]).alias("key"))


def _topics(spark, folder):
    df = table(spark, folder, "nation")
    explicit = F.when(F.col("n_regionkey") == 1, F.lit("")).when(F.col("n_regionkey") == 2, F.concat(F.lit("own."), "n_name"))
    return df.select("n_nationkey", topic_name(explicit, "changes", F.col("n_name")).alias("topic"))


def _json(spark, folder):
    df = table(spark, folder, "orders")
    return df.select("o_orderkey", record_json(df.schema, precision="second").alias("value"))


def _partitions_per_key(spark, folder):
    placed = colocate(table(spark, folder, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])
    return placed.groupBy("o_custkey", F.spark_partition_id().alias("p")).count().groupBy("o_custkey").agg(
        F.count("*").alias("partitions"), F.sum("count").alias("rows")
    )


def _contiguous(spark, folder):
    placed = contiguous(table(spark, folder, "events"), "event_type", ["ts", "event_id"])
    return placed.select("event_type", F.spark_partition_id().alias("p"), "ts").groupBy("event_type").agg(
        F.count("*").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last")
    )


JSON_ORDER = """'{"o_custkey":' || o_custkey || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  || '","o_orderkey":' || o_orderkey || ',"o_orderpriority":' || to_json(o_orderpriority)
  || ',"o_orderstatus":' || to_json(o_orderstatus) || ',"o_totalprice":' || to_json(o_totalprice) || '}'"""

QUERIES = {
    "key_identifier": Query(
        _keyed("customer", "c_custkey", lambda schema: identifier_key(schema, "c_custkey")),
        "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key FROM customer",
    ),
    "key_round_robin": Query(
        _keyed("customer", "c_custkey", lambda schema: no_key()),
        "SELECT c_custkey, CAST(NULL AS VARCHAR) AS key FROM customer",
    ),
    "key_composite": Query(
        _keyed("customer", "c_custkey", lambda schema: composite_key(schema, ["c_nationkey", "c_mktsegment"])),
        "SELECT c_custkey, sha256(c_mktsegment || chr(0) || CAST(c_nationkey AS VARCHAR)) AS key FROM customer",
    ),
    "key_composite_missing": Query(
        _nullable,
        f"""SELECT event_id, sha256('' || chr(0) || CAST(event_id AS VARCHAR) || chr(0) || coalesce(state, '')) AS key
            FROM {STATES}""",
    ),
    "colocate_keys": Query(
        _partitions_per_key,
        """SELECT o_custkey, CAST(1 AS BIGINT) AS partitions, CAST(count(*) AS BIGINT) AS "rows"
           FROM orders GROUP BY o_custkey""",
    ),
    "contiguous_keys": Query(
        _contiguous,
        """SELECT event_type, CAST(count(*) AS BIGINT) AS "rows", min(ts) AS "first", max(ts) AS "last"
           FROM events GROUP BY event_type""",
    ),
    "topic_name": Query(
        _topics,
        """SELECT n_nationkey, coalesce(nullif(CASE n_regionkey WHEN 1 THEN '' WHEN 2 THEN 'own.' || n_name END, ''),
           'changes.' || n_name) AS topic FROM nation""",
    ),
    "record_json": Query(_json, f"SELECT o_orderkey, {JSON_ORDER} AS value FROM orders"),
    "record_json_text": Query(
        lambda s, f: table(s, f, "documents").select("doc_id", record_json(table(s, f, "documents").schema, ["text"]).alias("value")),
        """SELECT doc_id, '{"text":' || to_json(text) || '}' AS value FROM documents""",
    ),
    "message_envelope": Query(
        lambda s, f: readable(to_messages(table(s, f, "orders"), ORDERS, "changes")),
        f"""SELECT 'changes.orders' AS topic, CAST(o_orderkey AS VARCHAR) AS key, {JSON_ORDER} AS value,
            'source_table' AS header_key, 'orders' AS header_value FROM orders""",
    ),
    "message_envelope_hashed": Query(
        lambda s, f: readable(to_messages(table(s, f, "events"), EVENTS, "changes")).select("topic", "key", "header_value"),
        """SELECT 'changes.events' AS topic, sha256(event_type || chr(0) || CAST(user_id AS VARCHAR)) AS key,
           'events' AS header_value FROM events""",
    ),
    "flat_strings": Query(
        lambda s, f: table(s, f, "customer").select(*flat_strings(["c_custkey", "c_name", "c_nationkey", "c_acctbal"])),
        """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM customer""",
    ),
}
