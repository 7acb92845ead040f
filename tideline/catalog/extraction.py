"""Incremental pulls, drains, progress and lag."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.catalog.base import Query, table
from tideline.functions.timestamps import is_bad_ts, strict_ts
from tideline.operators.incremental import advance, lag_seconds, late_rows, pull
from tideline.operators.numbering import assign_batches
from tideline.specs import Progress, TableSpec

ORDERS = TableSpec("orders", "o_orderdate", "o_orderkey")
EVENTS = TableSpec("events", "ts", "event_id")
EVENT_SECONDS = TableSpec("events", "ts", "event_id", precision="second")
ORDERS_AT = Progress(datetime(1997, 5, 28), "1")
ORDERS_NOW = datetime(1998, 1, 1)
EVENTS_AT = Progress(datetime(2024, 1, 1, 8, 30, 5), "126")
EVENTS_NOW = datetime(2024, 1, 20, 12)


def _orders(spark, folder, progress=None, **kwargs):
    return pull(table(spark, folder, "orders"), ORDERS, progress, now=ORDERS_NOW, **kwargs)


def _events(spark, folder, spec=EVENTS, progress=None, **kwargs):
    return pull(table(spark, folder, "events"), spec, progress, now=EVENTS_NOW, **kwargs)


def bounded_pull(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder, ORDERS_AT, limit=20)


def unlabelled_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a landing zone could hold them: timestamps as text, some of them
    unreadable, and some identifiers missing."""
    good = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("place"),
        F.when(F.col("event_type") != "view", F.col("event_id")).alias("event_id"),
        F.when(F.col("event_type") == "error", F.concat(good, F.lit(".5")))
        .when(F.col("event_type") == "click", F.substring(good, 1, 10))
        .when(F.col("event_type") == "signup", F.lit("not-a-timestamp"))
        .otherwise(good)
        .alias("ts"),
    )


UNLABELLED = """
  SELECT event_id AS place, CASE WHEN event_type <> 'view' THEN event_id END AS event_id,
    CASE event_type WHEN 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.5'
      WHEN 'click' THEN strftime(ts, '%Y-%m-%d') WHEN 'signup' THEN 'not-a-timestamp'
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts
  FROM events"""


def _lag(spark, folder):
    df = table(spark, folder, "events").withColumnRenamed("event_type", "table")
    return lag_seconds(df, "table", "ts", datetime(2024, 2, 1))


def _strict(spark, folder):
    return unlabelled_events(spark, folder).select(
        "place", strict_ts("ts").alias("parsed"), is_bad_ts("ts").alias("is_bad")
    )


def _late(spark, folder):
    orders = table(spark, folder, "orders")
    published = orders.where(F.col("o_orderstatus") != "P")
    return late_rows(orders, ORDERS, Progress(datetime(1998, 1, 1), "500"), published)


def _numbered(spec, name, keep):
    return lambda spark, folder: assign_batches(table(spark, folder, name), spec, 20, keep=keep)


def _independent(spark, folder):
    return advance(
        unlabelled_events(spark, folder),
        TableSpec("events", "ts", "event_id", precision="second"),
        mode="independent",
        pos=F.col("place"),
    )


AFTER_ORDERS = """((o_orderdate = TIMESTAMP '1997-05-28' AND o_orderkey > 1)
  OR (o_orderdate > TIMESTAMP '1997-05-28' AND o_orderdate < TIMESTAMP '1998-01-01'))"""
AFTER_EVENTS = """((date_trunc('second', ts) = TIMESTAMP '2024-01-01 08:30:05' AND event_id > 126)
  OR (date_trunc('second', ts) > TIMESTAMP '2024-01-01 08:30:05'
      AND date_trunc('second', ts) < TIMESTAMP '2024-01-20 12:00:00'))"""

QUERIES = {
    "entry_bounded_pull": Query(
        bounded_pull, f"SELECT * FROM orders WHERE {AFTER_ORDERS} ORDER BY o_orderdate, o_orderkey LIMIT 20"
    ),
    "bounded_pull_backlog": Query(
        lambda s, f: _orders(s, f, ORDERS_AT), f"SELECT * FROM orders WHERE {AFTER_ORDERS}"
    ),
    "bounded_pull_no_identifier": Query(
        lambda s, f: _orders(s, f, Progress(datetime(1997, 5, 28))),
        "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-28' AND o_orderdate < TIMESTAMP '1998-01-01'",
    ),
    "bounded_pull_second": Query(
        lambda s, f: _events(s, f, EVENT_SECONDS, EVENTS_AT, limit=50),
        f"SELECT * FROM events WHERE {AFTER_EVENTS} ORDER BY date_trunc('second', ts), event_id LIMIT 50",
    ),
    "bounded_pull_second_backlog": Query(
        lambda s, f: _events(s, f, EVENT_SECONDS, EVENTS_AT), f"SELECT * FROM events WHERE {AFTER_EVENTS}"
    ),
    "unbounded_pull": Query(
        lambda s, f: _orders(s, f, limit=20),
        "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 20",
    ),
    "unbounded_pull_backlog": Query(
        lambda s, f: _orders(s, f), "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"
    ),
    "floor_pull": Query(
        lambda s, f: _events(s, f, initial_hours=240),
        """SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 240 HOUR
           AND ts < TIMESTAMP '2024-01-20 12:00:00'""",
    ),
    "progress_beats_floor": Query(
        lambda s, f: _events(s, f, progress=EVENTS_AT, initial_hours=24),
        """SELECT * FROM events WHERE (ts = TIMESTAMP '2024-01-01 08:30:05' AND event_id > 126)
           OR (ts > TIMESTAMP '2024-01-01 08:30:05' AND ts < TIMESTAMP '2024-01-20 12:00:00')""",
    ),
    "through_delay": Query(
        lambda s, f: _events(s, f, delay_seconds=86400),
        "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 86400 SECOND",
    ),
    "batch_assign": Query(
        _numbered(ORDERS, "orders", ["o_orderkey", "o_orderdate"]),
        """SELECT o_orderkey, o_orderdate, rn AS row_no, (rn - 1) // 20 AS batch_no FROM
           (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""",
    ),
    "batch_assign_second": Query(
        _numbered(EVENT_SECONDS, "events", ["event_id", "ts", "event_type"]),
        """SELECT event_id, ts, event_type, rn AS row_no, (rn - 1) // 20 AS batch_no FROM
           (SELECT *, row_number() OVER (ORDER BY date_trunc('second', ts), event_id) AS rn FROM events)""",
    ),
    "progress_advance": Query(
        lambda s, f: advance(_orders(s, f), ORDERS),
        """SELECT 'orders' AS "table", o_orderdate AS ts, CAST(o_orderkey AS VARCHAR) AS last_identifier FROM orders
           WHERE o_orderdate < TIMESTAMP '1998-01-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
    ),
    "progress_advance_second": Query(
        lambda s, f: advance(_events(s, f, EVENT_SECONDS), EVENT_SECONDS),
        """SELECT 'events' AS "table", date_trunc('second', ts) AS ts, CAST(event_id AS VARCHAR) AS last_identifier
           FROM events WHERE ts < TIMESTAMP '2024-01-20 12:00:00'
           ORDER BY date_trunc('second', ts) DESC, event_id DESC LIMIT 1""",
    ),
    "progress_advance_independent": Query(
        _independent,
        f"""WITH u AS ({UNLABELLED})
           SELECT 'events' AS "table",
             (SELECT try_strptime(ts, '%Y-%m-%d %H:%M:%S') FROM u
              WHERE try_strptime(ts, '%Y-%m-%d %H:%M:%S') IS NOT NULL ORDER BY place DESC LIMIT 1) AS ts,
             (SELECT CAST(event_id AS VARCHAR) FROM u WHERE event_id IS NOT NULL
              ORDER BY place DESC LIMIT 1) AS last_identifier""",
    ),
    "lag_by_table": Query(
        _lag,
        """SELECT event_type AS "table",
             CAST(epoch(TIMESTAMP '2024-02-01') - epoch(date_trunc('second', max(ts))) AS BIGINT) AS lag_seconds
           FROM events GROUP BY event_type""",
    ),
    "strict_ts": Query(
        _strict,
        f"""SELECT place, try_strptime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
             ts IS NOT NULL AND try_strptime(ts, '%Y-%m-%d %H:%M:%S') IS NULL AS is_bad FROM ({UNLABELLED})""",
    ),
    "late_rows_second": Query(
        lambda s, f: late_rows(table(s, f, "events"), EVENT_SECONDS, EVENTS_AT, table(s, f, "events").where("event_type <> 'error'")),
        """SELECT * FROM events WHERE event_type = 'error' AND (ts < TIMESTAMP '2024-01-01 08:30:05'
           OR (ts < TIMESTAMP '2024-01-01 08:30:06' AND event_id <= 126))""",
    ),
    "late_rows": Query(
        _late,
        """SELECT * FROM orders WHERE o_orderstatus = 'P' AND (o_orderdate < TIMESTAMP '1998-01-01'
           OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderkey <= 500))""",
    ),
}
