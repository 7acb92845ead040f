"""Change logs derived from the tables, and their application."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.catalog.base import Query, table
from tideline.operators.apply import (
    LOG_ORDER,
    dead_letters,
    fold_patches,
    merge_columns,
    merge_patches,
    new_rows,
    parse_log,
    record_fields,
    rejected_updates,
    route_topics,
    to_records,
    typed_updates,
)
from tideline.plans.apply import apply_log, missing_ids
from tideline.session import spread, stage
from tideline.specs import ApplySpec

NOW = datetime(2024, 2, 1)
ID = "sys_id"
ORDER_FIELDS = ("o_orderstatus", "qty", "tax", "note")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages about customers: updates with and without an explicit null,
    new rows without identifier or with a numeric one, and unreadable values."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    ident = F.col("user_id") * 11
    value = (
        F.when(kind == "purchase", _text('{"sys_id":"', ident, '","amount":"', k, '","last":"purchase"}'))
        .when(kind == "click", _text('{"sys_id":"', ident, '","last":"click","note":null}'))
        .when(kind == "view", _text('{"sys_id":', F.col("event_id"), ',"seen":"', k, '"}'))
        .when(kind == "signup", _text('{"channel":"k', k, '","note":null}'))
        .when(k.cast("int") % 4 == 0, _text(F.col("props"), " x"))
        .when(k.cast("int") % 4 == 1, _text("[", F.col("props"), "]"))
        .when(k.cast("int") % 4 == 2, _text(F.col("props"), " ", F.col("props")))
        .otherwise("null")
    )
    return spread(table(spark, folder, "events")).select(
        F.concat(F.lit("customers."), kind).alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        value.alias("value"),
    )


EVENT_LOG = """
  SELECT 'customers.' || event_type AS topic, CAST(user_id % 8 AS INTEGER) AS partition, event_id AS "offset",
    ts AS "timestamp", CAST(user_id * 11 AS VARCHAR) AS ident, props->>'k' AS k, event_type,
    CASE event_type
      WHEN 'purchase' THEN '{"sys_id":"' || user_id * 11 || '","amount":"' || (props->>'k') || '","last":"purchase"}'
      WHEN 'click' THEN '{"sys_id":"' || user_id * 11 || '","last":"click","note":null}'
      WHEN 'view' THEN '{"sys_id":' || event_id || ',"seen":"' || (props->>'k') || '"}'
      WHEN 'signup' THEN '{"channel":"k' || (props->>'k') || '","note":null}'
      ELSE CASE CAST(props->>'k' AS INTEGER) % 4 WHEN 0 THEN props || ' x' WHEN 1 THEN '[' || props || ']'
        WHEN 2 THEN props || ' ' || props ELSE 'null' END END AS value
  FROM events"""
PARSED = f"""
  SELECT *, CASE WHEN ok AND json_type(value, '$.sys_id') = 'VARCHAR' AND value->>'sys_id' <> ''
      THEN value->>'sys_id' END AS id,
    CASE WHEN NOT ok THEN 'reject' WHEN json_type(value, '$.sys_id') = 'VARCHAR' AND value->>'sys_id' <> ''
      THEN 'update' ELSE 'insert' END AS operation,
    CASE WHEN NOT ok THEN 'deserializing record: not a JSON object (raw: ' || substring(value, 1, 200) || ')' END AS error
  FROM (SELECT *, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE FALSE END AS ok
        FROM ({EVENT_LOG}))"""
NEW_ID = """md5(topic || '|' || partition || '|' || "offset")"""
FAILED = f"""
  SELECT *, error AS reason FROM p WHERE operation = 'reject'
  UNION ALL SELECT *, 'updating record ' || id || ': no such record' FROM p
  WHERE operation = 'update' AND id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)"""


def order_log(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as patches of their order, several per order; some leave out a field,
    some clear one."""
    tax = F.when(F.col("l_tax") > 0, _text(',"tax":"', F.col("l_tax"), '"')).otherwise("")
    note = F.when(F.col("l_returnflag") == "N", ',"note":null').otherwise(_text(',"note":"', F.col("l_returnflag"), '"'))
    head = _text('{"sys_id":"', F.col("l_orderkey"), '","o_orderstatus":"', F.col("l_linestatus"), '","qty":"')
    return spread(table(spark, folder, "lineitem")).select(
        F.lit("orders").alias("topic"),
        F.col("l_linenumber").alias("partition"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("offset"),
        F.col("l_shipdate").alias("timestamp"),
        _text(head, F.col("l_quantity"), '"', tax, note, "}").alias("value"),
    )


FOLDED = """
  SELECT id, field, val FROM (
    SELECT *, row_number() OVER (PARTITION BY id, field ORDER BY t DESC, p DESC, o DESC) AS rn FROM (
      SELECT CAST(l_orderkey AS VARCHAR) AS id, l_shipdate AS t, l_linenumber AS p,
        l_partkey * 1000000 + l_suppkey AS o, f.field AS field, f.val AS val
      FROM lineitem, unnest([
        {'field': 'o_orderstatus', 'val': l_linestatus, 'present': TRUE},
        {'field': 'qty', 'val': CAST(l_quantity AS VARCHAR), 'present': TRUE},
        {'field': 'tax', 'val': CAST(l_tax AS VARCHAR), 'present': l_tax > 0},
        {'field': 'note', 'val': CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, 'present': TRUE}]) AS u(f)
      WHERE f.present)) WHERE rn = 1"""
ORDER_RECORDS = """
  SELECT CAST(o_orderkey AS VARCHAR) AS id, unnest(['o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
      'o_orderpriority']) AS field,
    unnest([CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR),
      CAST(o_orderdate AS VARCHAR), o_orderpriority]) AS val
  FROM orders"""
CUSTOMER_RECORDS = """
  SELECT CAST(c_custkey AS VARCHAR) AS id, unnest(['c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS field,
    unnest([c_name, CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR), c_mktsegment]) AS val
  FROM customer"""
APPLIED = f"""
  WITH p AS ({PARSED}),
  patch AS (
    SELECT id, field, val FROM (
      SELECT *, row_number() OVER (PARTITION BY id, field ORDER BY "timestamp" DESC, partition DESC, "offset" DESC) AS rn
      FROM (
        SELECT id, "timestamp", partition, "offset", f.field AS field, f.val AS val FROM p, unnest([
          {{'field': 'amount', 'val': k, 'present': event_type = 'purchase'}},
          {{'field': 'last', 'val': event_type, 'present': TRUE}},
          {{'field': 'note', 'val': NULL, 'present': event_type = 'click'}}]) AS u(f)
        WHERE operation = 'update' AND f.present AND id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)))
    WHERE rn = 1),
  target AS ({CUSTOMER_RECORDS}),
  added AS (
    SELECT {NEW_ID} AS id, f.field AS field, f.val AS val FROM p, unnest([
      {{'field': 'seen', 'val': k, 'present': event_type = 'view'}},
      {{'field': 'channel', 'val': 'k' || k, 'present': event_type = 'signup'}},
      {{'field': 'note', 'val': NULL, 'present': event_type = 'signup'}}]) AS u(f)
    WHERE operation = 'insert' AND f.present)
  SELECT id, field, val FROM patch UNION ALL SELECT id, field, val FROM added
  UNION ALL SELECT id, field, val FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM patch WHERE patch.id = t.id AND patch.field = t.field)"""


def order_updates(spark, folder):
    return parse_log(order_log(spark, folder), ID).select("id", "rec", *LOG_ORDER)


def _fold(fields=()):
    return lambda spark, folder: record_fields(fold_patches(order_updates(spark, folder), fields=fields))


def order_records(spark, folder):
    return to_records(table(spark, folder, "orders"), "o_orderkey")


def _merge(spark, folder):
    folded = fold_patches(stage(order_updates(spark, folder), "parsed"))
    return record_fields(merge_patches(order_records(spark, folder), folded))


def _merge_columns(spark, folder):
    folded = fold_patches(stage(order_updates(spark, folder), "parsed"), fields=("o_orderstatus",))
    return merge_columns(table(spark, folder, "orders"), "o_orderkey", folded)


TYPED_LOG = """
  SELECT l_shipdate AS t, l_linenumber AS part, l_partkey * 1000000 + l_suppkey AS "offset", CAST(l_orderkey AS VARCHAR) AS id,
    CASE l_linenumber % 3 WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN 'about ' || CAST(l_quantity AS VARCHAR) END AS price,
    CASE WHEN l_returnflag = 'R' THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS day
  FROM lineitem"""


def _typed(spark, folder):
    """Line items as patches of typed columns of their order: some prices and days are no numbers and no days, some prices are cleared."""
    lines = table(spark, folder, "lineitem")
    number, kind = F.col("l_quantity").cast("string"), F.col("l_linenumber") % 3
    price = F.when(kind == 0, number).when(kind == 1, _text("about ", number))
    day = F.when(F.col("l_returnflag") == "R", "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    updates = lines.select(
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_linenumber").alias("partition"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("offset"),
        F.col("l_orderkey").cast("string").alias("id"),
        F.create_map(F.lit("o_totalprice"), price, F.lit("o_orderdate"), day).alias("rec"),
    )
    return typed_updates(updates, table(spark, folder, "orders").schema, "o_orderkey")


def _typed_dead(spark, folder):
    return _typed(spark, folder).where("error IS NOT NULL").select("offset", "id", "error")


def _typed_merge(spark, folder):
    folded = fold_patches(_typed(spark, folder).where("error IS NULL"))
    return merge_columns(table(spark, folder, "orders"), "o_orderkey", folded)


def _parsed(spark, folder):
    return stage(parse_log(event_log(spark, folder), ID), "parsed")


def _routes(spark, folder):
    return parse_log(event_log(spark, folder), ID).select("offset", "id", "operation", "error")


def _documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("value"))
    return parse_log(docs, ID).select("doc_id", "operation", "error")


def _customers(spark, folder):
    return to_records(table(spark, folder, "customer"), "c_custkey")


def _inserts(spark, folder):
    return record_fields(new_rows(_parsed(spark, folder)))


def _rejects(spark, folder):
    parsed = _parsed(spark, folder)
    updates = parsed.where(F.col("operation") == "update")
    unknown = missing_ids(parsed, _customers(spark, folder))
    return rejected_updates(updates, unknown).select("offset", "id", "error")


def _apply(spark, folder):
    return apply_log(event_log(spark, folder), _customers(spark, folder), ApplySpec("customers"))


def _dead(spark, folder):
    return dead_letters(_apply(spark, folder)[1], "customers", NOW)


def _mapped(spark, folder):
    nations = table(spark, folder, "nation").select("n_name", "n_regionkey")
    regions = table(spark, folder, "region")
    routes = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("topic"), F.col("r_name").alias("table")
    )
    log = table(spark, folder, "customer").select(
        F.concat(F.lit("NATION_"), F.col("c_custkey") % 30).alias("topic"), F.col("c_name").alias("value")
    )
    return route_topics(log, routes)


QUERIES = {
    "parse_route": Query(
        _routes, f'WITH p AS ({PARSED}) SELECT "offset", id, operation, error FROM p'
    ),
    "parse_documents": Query(
        _documents,
        """SELECT doc_id, 'reject' AS operation,
             'deserializing record: not a JSON object (raw: ' || substring(text, 1, 200) || ')' AS error
           FROM documents WHERE NOT json_valid(text)
           UNION ALL SELECT doc_id, 'insert', NULL FROM documents WHERE json_valid(text)""",
    ),
    "fold_patches": Query(_fold(), FOLDED),
    "fold_named_fields": Query(_fold(ORDER_FIELDS), FOLDED),
    "fold_some_fields": Query(_fold(ORDER_FIELDS[:2]), FOLDED),
    "merge_patches": Query(
        _merge,
        f"""WITH patch AS MATERIALIZED ({FOLDED}), target AS MATERIALIZED ({ORDER_RECORDS})
            SELECT id, field, val FROM patch SEMI JOIN target USING (id) UNION ALL
            SELECT id, field, val FROM target ANTI JOIN patch USING (id, field)""",
    ),
    "merge_columns": Query(
        _merge_columns,
        f"""SELECT o_orderkey, o_custkey, coalesce(val, o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
              o_orderpriority
            FROM orders LEFT JOIN (SELECT * FROM ({FOLDED}) WHERE field = 'o_orderstatus')
              ON id = CAST(o_orderkey AS VARCHAR)""",
    ),
    "typed_updates": Query(
        _typed_dead,
        f"""WITH p AS ({TYPED_LOG}) SELECT "offset", id, 'updating record ' || id || ': no value of the column''s type: '
              || concat_ws(', ', CASE WHEN try_cast(price AS DOUBLE) IS NULL THEN 'o_totalprice = ' || price END,
                CASE WHEN try_cast(day AS TIMESTAMP) IS NULL THEN 'o_orderdate = ' || day END) AS error
            FROM p WHERE (price IS NOT NULL AND try_cast(price AS DOUBLE) IS NULL) OR try_cast(day AS TIMESTAMP) IS NULL""",
    ),
    "typed_merge": Query(
        _typed_merge,
        f"""WITH p AS ({TYPED_LOG}), good AS (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, part DESC, "offset" DESC) AS rn FROM p
              WHERE (price IS NULL OR try_cast(price AS DOUBLE) IS NOT NULL) AND try_cast(day AS TIMESTAMP) IS NOT NULL)
            SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN id IS NULL THEN o_totalprice ELSE CAST(price AS DOUBLE) END AS o_totalprice,
              coalesce(CAST(day AS TIMESTAMP), o_orderdate) AS o_orderdate, o_orderpriority
            FROM orders LEFT JOIN (SELECT * FROM good WHERE rn = 1) ON id = CAST(o_orderkey AS VARCHAR)""",
    ),
    "insert_ids": Query(
        _inserts,
        f"""WITH p AS ({PARSED}) SELECT {NEW_ID} AS id, f.field AS field, f.val AS val FROM p, unnest([
              {{'field': 'seen', 'val': k, 'present': event_type = 'view'}},
              {{'field': 'channel', 'val': 'k' || k, 'present': event_type = 'signup'}},
              {{'field': 'note', 'val': NULL, 'present': event_type = 'signup'}}]) AS u(f)
            WHERE operation = 'insert' AND f.present""",
    ),
    "reject_unknown": Query(
        _rejects,
        f"""WITH p AS ({PARSED}) SELECT "offset", id, reason AS error FROM ({FAILED}) WHERE operation = 'update'""",
    ),
    "dead_letters": Query(
        _dead,
        f"""WITH p AS ({PARSED}) SELECT value AS original_payload, reason AS error,
              '2024-02-01T00:00:00Z' AS "timestamp", topic, 'customers' AS "table", partition, "offset"
            FROM ({FAILED})""",
    ),
    "apply_log": Query(lambda s, f: record_fields(_apply(s, f)[0]), APPLIED),
    "topic_map": Query(
        _mapped,
        """SELECT 'NATION_' || c_custkey % 30 AS topic, c_name AS value, r_name AS "table"
           FROM customer JOIN nation ON n_name = 'NATION_' || c_custkey % 30 JOIN region ON n_regionkey = r_regionkey""",
    ),
}
