"""Targets in buckets, folders read by the range of each file, and streams that keep state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideline.catalog.applying import APPLIED, FAILED, FOLDED, ID, PARSED, _customers, event_log, order_log
from tideline.catalog.base import Query, table
from tideline.catalog.extraction import AFTER_ORDERS, ORDERS, ORDERS_AT, ORDERS_NOW
from tideline.operators.apply import record_fields
from tideline.session import scratch_root
from tideline.sinks.buckets import BucketedTable, apply_to_buckets
from tideline.sinks.targets import DeadLetterTable, RecordTable
from tideline.sources.logs import LOG_SCHEMA, read_files, stream_files
from tideline.sources.skipping import FileRanges
from tideline.specs import ApplySpec
from tideline.streaming.queries import stream_apply
from tideline.streaming.stateful import late, once, read_fold, read_on_time, stream_fold, stream_on_time

BUCKETS = 64
DELIVERIES = ("2024-01-20", "2024-01-10")
"""Events since the first day are delivered first, then those since the second, then the rest."""
WITHIN = "26 days"


def _folder(spark) -> str:
    return f"{scratch_root(spark)}/layout-{uuid.uuid4().hex}"


def bucketed_customers(spark, folder) -> BucketedTable:
    name = f"customers_{uuid.uuid4().hex}"
    target = BucketedTable(spark, name, BUCKETS)
    target.create(_customers(spark, folder), _folder(spark))
    return target


def _applied(spark, folder):
    target = bucketed_customers(spark, folder)
    return target, *apply_to_buckets(event_log(spark, folder), target, ApplySpec("customers"))


def _buckets_changed(spark, folder):
    return record_fields(_applied(spark, folder)[1])


def _buckets_after(spark, folder):
    target, changed, _ = _applied(spark, folder)
    return record_fields(target.after(changed))


def _buckets_failed(spark, folder):
    return _applied(spark, folder)[2].select("value", "error")


def ordered_files(spark, folder) -> FileRanges:
    """The orders in 16 files by date, and the ranges of the files."""
    base = _folder(spark)
    table(spark, folder, "orders").repartitionByRange(16, "o_orderdate").write.parquet(f"{base}/orders")
    ranges = FileRanges(spark, f"{base}/orders", ORDERS, f"{base}/ranges")
    ranges.refresh()
    return ranges


def _skipping(spark, folder):
    return ordered_files(spark, folder).pull(ORDERS_AT, now=ORDERS_NOW)


def _fold_stream(spark, folder):
    base = _folder(spark)
    log = order_log(spark, folder)
    for part in range(3):
        log.where(F.col("partition") % 3 == part).write.mode("append").parquet(f"{base}/log")
    stream_fold(stream_files(spark, f"{base}/log", 8), f"{base}/fold", f"{base}/checkpoint", id_field=ID).awaitTermination()
    return record_fields(read_fold(spark, f"{base}/fold"))


def _twice_dead(spark, folder):
    """A topic delivered twice."""
    base = _folder(spark)
    log = event_log(spark, folder).withColumn("topic", F.lit("customers")).coalesce(1)
    for _ in range(2):
        log.write.mode("append").parquet(f"{base}/log")
    target, dead = RecordTable(spark, f"{base}/target"), DeadLetterTable(f"{base}/dead")
    target.create(_customers(spark, folder))
    delivered = once(stream_files(spark, f"{base}/log", 1), "60 days")
    stream_apply(delivered, "customers", target, ApplySpec("customers"), f"{base}/checkpoint", dead=dead).awaitTermination()
    return dead.read(spark).select("original_payload", "error", "topic", "table", "partition", "offset")


def _late(spark, folder):
    base = _folder(spark)
    ts, log = F.col("timestamp"), event_log(spark, folder).coalesce(1)
    first, second = (F.lit(day).cast("timestamp_ntz") for day in DELIVERIES)
    for part in (ts >= first, (ts >= second) & (ts < first), ts < second):
        log.where(part).write.mode("append").parquet(f"{base}/log")
    stream_on_time(stream_files(spark, f"{base}/log", 1), WITHIN, f"{base}/once", f"{base}/checkpoint").awaitTermination()
    return late(read_files(spark, f"{base}/log"), read_on_time(spark, f"{base}/once", LOG_SCHEMA)).select(
        "topic", "partition", "offset", "timestamp"
    )


QUERIES = {
    "bucketed_changed": Query(
        _buckets_changed,
        APPLIED + " AND id IN (SELECT id FROM patch)",
    ),
    "bucketed_after": Query(_buckets_after, APPLIED),
    "bucketed_failed": Query(
        _buckets_failed, f"WITH p AS ({PARSED}) SELECT value, reason AS error FROM ({FAILED})"
    ),
    "skipping_pull": Query(_skipping, f"SELECT * FROM orders WHERE {AFTER_ORDERS}"),
    "stream_fold": Query(_fold_stream, FOLDED),
    "stream_delivered_twice": Query(
        _twice_dead,
        f"""WITH p AS ({PARSED}) SELECT value AS original_payload, reason AS error, 'customers' AS topic,
              'customers' AS "table", partition, "offset" FROM ({FAILED})""",
    ),
    "stream_late": Query(
        _late,
        f"""SELECT 'customers.' || event_type AS topic, CAST(user_id % 8 AS INTEGER) AS partition, event_id AS "offset", ts AS "timestamp"
            FROM events WHERE ts < TIMESTAMP '{DELIVERIES[1]}' AND ts <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL {WITHIN}""",
    ),
}
