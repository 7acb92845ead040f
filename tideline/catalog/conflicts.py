"""Records that several sources change, and instances that share identifiers."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.catalog.applying import FOLDED, ORDER_RECORDS, order_records, order_updates
from tideline.catalog.base import Query, table
from tideline.catalog.extraction import ORDERS, ORDERS_AT, ORDERS_NOW
from tideline.operators.apply import fold_patches, record_fields, to_records
from tideline.operators.conflicts import ReviewQueue, agreed, differences, field_clocks, newest_wins, system_of_record
from tideline.operators.messages import readable
from tideline.plans.instances import progress_name, pull_instances
from tideline.session import scratch_root
from tideline.sinks.logs import FileLog
from tideline.sources.progress import ProgressStore
from tideline.specs import PullSettings

NEVER = datetime(1990, 1, 1)


def _newest(spark, folder):
    """Orders as known two months after their date, against patches by their line items."""
    seen = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("at")
    )
    ours = record_fields(order_records(spark, folder).join(seen, "id"), "at")
    return newest_wins({"orders": ours, "lines": field_clocks(order_updates(spark, folder))})


def _of_record(spark, folder):
    key = F.col("o_orderkey")
    crm = table(spark, folder, "orders").select(
        key, F.lit("C").alias("o_orderstatus"), F.when(key % 3 == 0, F.lit("crm")).alias("note"), F.lit("crm").alias("tax")
    )
    sources = {
        "erp": order_records(spark, folder),
        "lines": fold_patches(order_updates(spark, folder)),
        "crm": to_records(crm, "o_orderkey"),
    }
    return system_of_record(sources, {"o_orderstatus": "crm", "o_totalprice": "lines"})


def _version(orders: DataFrame, **fields: tuple[Column, Column]) -> DataFrame:
    """Records with the fields whose first part holds, set to the second."""
    entry = [
        F.when(present, F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))) for name, (present, value) in fields.items()
    ]
    rec = F.map_from_entries(F.filter(F.array(*entry), lambda e: e.isNotNull()))
    return orders.select(F.col("o_orderkey").cast("string").alias("id"), rec.alias("rec"))


def _versions(spark, folder):
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    yes, none = F.lit(True), F.lit(None).cast("string")
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    base = _version(orders, status=(yes, status), price=(yes, price), priority=(yes, priority))
    ours = _version(
        orders,
        status=(yes, F.when(key % 3 == 0, "X").otherwise(status)),
        price=(yes, F.when(key % 7 != 0, price)),
        priority=(key % 5 != 0, priority),
        note=(key % 18 == 0, none),
    )
    theirs = _version(
        orders,
        status=(yes, F.when(key % 6 == 0, "X").when(key % 4 == 0, "Y").when(key % 15 == 0, "Z").otherwise(status)),
        price=(yes, F.when(key % 14 != 0, price)),
        priority=(yes, F.when(key % 10 != 0, priority)),
        note=(key % 9 == 0, F.lit("n")),
    )
    return base, ours, theirs


def _differences(spark, folder):
    changes = differences(*_versions(spark, folder))
    return changes.select("id", "field", "state", *[F.col(v)["val"].alias(v) for v in ("base", "ours", "theirs")])


def _agreed(spark, folder):
    return agreed(differences(*_versions(spark, folder)))


def _review(spark, folder):
    """Two runs over the same versions, the second made twice; between them the status entries were closed."""
    queue = ReviewQueue(spark, f"{scratch_root(spark)}/review-{uuid.uuid4().hex}")
    changes = differences(*_versions(spark, folder))
    queue.add(changes, 0)
    queue.close(queue.open().where(F.col("field") == "status"), 0)
    queue.add(changes, 1)
    queue.add(changes, 1)
    return queue.open().drop("entry")


def _pulled(spark, folder):
    """Two instances with equal ids; one of them has been pulled before."""
    base = f"{scratch_root(spark)}/instances-{uuid.uuid4().hex}"
    orders = table(spark, folder, "orders")
    sink, store = FileLog(f"{base}/log"), ProgressStore(spark, f"{base}/progress")
    store.set(progress_name("east", ORDERS), ORDERS_AT)
    store.flush(progress_name("east", ORDERS))
    west = orders.where(F.col("o_orderkey") % 3 == 0)
    empty = orders.where(F.col("o_orderdate") < F.lit(NEVER))
    tables = {"east": orders, "west": west, "north": empty}
    pull_instances(tables, ORDERS, store, sink, now=ORDERS_NOW, settings=PullSettings(topic_prefix="changes"))
    return sink, store


def _instances(spark, folder):
    value = F.col("value")
    return readable(_pulled(spark, folder)[0].read(spark)).select(
        "topic",
        "key",
        F.get_json_object(value, "$.instance").alias("instance"),
        F.get_json_object(value, "$.o_orderkey").cast("bigint").alias("o_orderkey"),
    )


def _instances_progress(spark, folder):
    return _pulled(spark, folder)[1].stored().select("table", "ts", "last_identifier")


CLOCKED = FOLDED.replace("SELECT id, field, val FROM (", "SELECT id, field, val, t AS at FROM (", 1)
VERSIONS = """
  SELECT id, field, base, ours, theirs, bp, op, tp,
    bp <> op OR base IS DISTINCT FROM ours AS mine, bp <> tp OR base IS DISTINCT FROM theirs AS other,
    op <> tp OR ours IS DISTINCT FROM theirs AS apart
  FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id, f.field AS field, f.b AS base, CASE WHEN f.op THEN f.o END AS ours,
      CASE WHEN f.tp THEN f.t END AS theirs, f.bp AS bp, f.op AS op, f.tp AS tp
    FROM orders, unnest([
      {'field': 'status', 'bp': TRUE, 'b': o_orderstatus, 'op': TRUE, 'o': CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END,
       'tp': TRUE, 't': CASE WHEN o_orderkey % 6 = 0 THEN 'X' WHEN o_orderkey % 4 = 0 THEN 'Y' WHEN o_orderkey % 15 = 0 THEN 'Z'
         ELSE o_orderstatus END},
      {'field': 'price', 'bp': TRUE, 'b': CAST(o_totalprice AS VARCHAR), 'op': TRUE,
       'o': CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS VARCHAR) END,
       'tp': TRUE, 't': CASE WHEN o_orderkey % 14 <> 0 THEN CAST(o_totalprice AS VARCHAR) END},
      {'field': 'priority', 'bp': TRUE, 'b': o_orderpriority, 'op': o_orderkey % 5 <> 0, 'o': o_orderpriority,
       'tp': TRUE, 't': CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END},
      {'field': 'note', 'bp': FALSE, 'b': NULL, 'op': o_orderkey % 18 = 0, 'o': NULL, 'tp': o_orderkey % 9 = 0, 't': 'n'}]) AS u(f))"""
STATED = f"""
  SELECT *, CASE WHEN mine AND other THEN CASE WHEN apart THEN 'conflict' ELSE 'both' END WHEN mine THEN 'ours' ELSE 'theirs' END AS state
  FROM ({VERSIONS}) WHERE mine OR other"""
EAST = "o_orderdate < TIMESTAMP '1998-01-01' AND (o_orderdate > TIMESTAMP '1997-05-28' OR (o_orderdate = TIMESTAMP '1997-05-28' AND o_orderkey > 1))"
WEST = "o_orderdate < TIMESTAMP '1998-01-01' AND o_orderkey % 3 = 0"
BOTH = f"SELECT 'east' AS instance, * FROM orders WHERE {EAST} UNION ALL SELECT 'west', * FROM orders WHERE {WEST}"

QUERIES = {
    "newest_wins": Query(
        _newest,
        f"""WITH ours AS (SELECT r.*, o_orderdate + INTERVAL 60 DAY AS at FROM ({ORDER_RECORDS}) r
              JOIN orders ON r.id = CAST(o_orderkey AS VARCHAR)), lines AS ({CLOCKED})
            SELECT coalesce(o.id, l.id) AS id, coalesce(o.field, l.field) AS field,
              CASE WHEN l.id IS NULL OR o.at >= l.at THEN o.val ELSE l.val END AS val,
              CASE WHEN l.id IS NULL OR o.at >= l.at THEN o.at ELSE l.at END AS at,
              CASE WHEN l.id IS NULL OR o.at >= l.at THEN 'orders' ELSE 'lines' END AS side
            FROM ours o FULL JOIN lines l ON o.id = l.id AND o.field = l.field""",
    ),
    "system_of_record": Query(
        _of_record,
        f"""WITH crm AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, unnest(['o_orderstatus', 'note', 'tax']) AS field,
              unnest(['C', CASE WHEN o_orderkey % 3 = 0 THEN 'crm' END, 'crm']) AS val FROM orders),
            ranked AS (
              SELECT *, 'erp' AS source, 1 AS rank FROM ({ORDER_RECORDS})
              UNION ALL SELECT *, 'lines', 2 FROM ({FOLDED})
              UNION ALL SELECT *, 'crm', CASE WHEN field = 'o_orderstatus' THEN 0 ELSE 3 END FROM crm)
            SELECT id, field, val, source FROM ranked QUALIFY row_number() OVER (PARTITION BY id, field ORDER BY rank) = 1""",
    ),
    "three_way_differences": Query(_differences, f"SELECT id, field, state, base, ours, theirs FROM ({STATED})"),
    "three_way_agreed": Query(
        _agreed,
        f"""SELECT id, field, CASE WHEN state = 'theirs' THEN tp ELSE op END AS present,
              CASE WHEN state = 'theirs' THEN theirs ELSE ours END AS val FROM ({STATED}) WHERE state <> 'conflict'""",
    ),
    "review_queue": Query(
        _review,
        f"""SELECT id, field, base, ours, theirs, CAST(CASE WHEN field = 'status' THEN 1 ELSE 0 END AS BIGINT) AS run
            FROM ({STATED}) WHERE state = 'conflict'""",
    ),
    "pull_instances": Query(
        _instances,
        f"""SELECT 'changes.orders' AS topic, sha256(instance || chr(0) || CAST(o_orderkey AS VARCHAR)) AS key, instance, o_orderkey
            FROM ({BOTH})""",
    ),
    "pull_instances_progress": Query(
        _instances_progress,
        f"""SELECT instance || '.orders' AS "table", o_orderdate AS ts, CAST(o_orderkey AS VARCHAR) AS last_identifier FROM ({BOTH})
            QUALIFY row_number() OVER (PARTITION BY instance ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    ),
}
