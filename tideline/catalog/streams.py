"""Jobs and streaming queries run end to end over the tables."""

from __future__ import annotations

import contextlib
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tideline.catalog.applying import APPLIED, FAILED, PARSED, _customers, event_log
from tideline.catalog.base import Query, table
from tideline.catalog.extraction import ORDERS_NOW
from tideline.catalog.messages import JSON_ORDER
from tideline.catalog.messages import ORDERS as ORDER_MESSAGES
from tideline.operators.apply import record_fields
from tideline.operators.messages import readable
from tideline.plans.pull import pull_once
from tideline.session import scratch_root, stage
from tideline.sinks.logs import FileLog
from tideline.sinks.targets import DeadLetterTable, RecordTable
from tideline.sources.logs import stream_files
from tideline.sources.progress import ProgressStore
from tideline.specs import ApplySpec, PullSettings, TableSpec
from tideline.streaming.queries import stream_apply, stream_publish


SPLIT = "2024-01-16 00:00:00"
FIRST_PULL = datetime(1996, 6, 1)


def _folder(spark) -> str:
    return f"{scratch_root(spark)}/job-{uuid.uuid4().hex}"


def _pulled(spark, folder):
    base = _folder(spark)
    sink, store = FileLog(f"{base}/log"), ProgressStore(spark, f"{base}/progress")
    settings = PullSettings(topic_prefix="changes")
    pull_once(table(spark, folder, "orders"), ORDER_MESSAGES, store, sink, now=ORDERS_NOW, settings=settings)
    return base, sink, store


def _pull_once(spark, folder):
    return readable(_pulled(spark, folder)[1].read(spark))


def _pull_progress(spark, folder):
    store = _pulled(spark, folder)[2]
    waiting = TableSpec("customer", "updated", "c_custkey")
    return store.load([ORDER_MESSAGES, waiting]).select("table", "ts", "last_identifier")


class _Stopped(FileLog):
    """A log whose publisher is lost just after the files are there, once."""

    def publish(self, messages, batch):
        super().publish(messages, batch)
        if not self.stopped:
            self.stopped = True
            raise RuntimeError("publisher lost")

    stopped = False


def _round_trip(spark, folder):
    """Two pulls, the first of them lost after its files were written and made again; the log is then read as a topic and applied."""
    base = _folder(spark)
    log, store = _Stopped(f"{base}/log", partitions=4), ProgressStore(spark, f"{base}/progress")
    orders, settings = table(spark, folder, "orders"), PullSettings(topic_prefix="changes")
    for now in (FIRST_PULL, FIRST_PULL, ORDERS_NOW):
        with contextlib.suppress(RuntimeError):
            pull_once(orders, ORDER_MESSAGES, store, log, now=now, settings=settings)
    target = RecordTable(spark, f"{base}/target")
    stream_apply(
        stream_files(spark, log.path), "changes.orders", target, ApplySpec("orders"), f"{base}/checkpoint"
    ).awaitTermination()
    return record_fields(target.read()).where(F.col("field").isin("o_orderkey", "o_orderstatus", "o_orderdate"))


def _stream_publish(spark, folder):
    base = _folder(spark)
    sink, store = FileLog(f"{base}/log"), ProgressStore(spark, f"{base}/progress")
    schema = table(spark, folder, "orders").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(folder)
    settings = PullSettings(topic_prefix="changes")
    stream_publish(rows, ORDER_MESSAGES, store, sink, f"{base}/checkpoint", settings=settings).awaitTermination()
    return readable(sink.read(spark))


def _streamed(spark, folder):
    base = _folder(spark)
    event_log(spark, folder).withColumn("topic", F.lit("customers")).write.parquet(f"{base}/log")
    target, dead = RecordTable(spark, f"{base}/target"), DeadLetterTable(f"{base}/dead")
    target.create(_customers(spark, folder))
    log = stream_files(spark, f"{base}/log")
    stream_apply(
        log, "customers", target, ApplySpec("customers"), f"{base}/checkpoint", dead=dead
    ).awaitTermination()
    return target, dead


def _stream_apply(spark, folder):
    return record_fields(_streamed(spark, folder)[0].read())


def _two_topics(spark, folder):
    """Two topics, one target and one store of dead letters; after a compaction the first topic is read anew."""
    base = _folder(spark)
    topic = F.when(F.col("timestamp") < F.lit(SPLIT).cast("timestamp_ntz"), F.lit("early")).otherwise(F.lit("late"))
    event_log(spark, folder).withColumn("topic", topic).write.parquet(f"{base}/log")
    target, dead = RecordTable(spark, f"{base}/target"), DeadLetterTable(f"{base}/dead")
    target.create(_customers(spark, folder))

    def apply(topic: str, checkpoint: str) -> None:
        log = stream_files(spark, f"{base}/log")
        stream_apply(
            log, topic, target, ApplySpec("customers"), f"{base}/{checkpoint}", dead=dead
        ).awaitTermination()

    apply("early", "first")
    apply("late", "second")
    letters = stage(dead.read(spark).groupBy("topic").agg(F.count("*").alias("letters")), "letters")
    target.compact(0)
    apply("late", "third")
    return target, letters


def _two_topics_applied(spark, folder):
    return record_fields(_two_topics(spark, folder)[0].read())


def _two_topics_dead(spark, folder):
    return _two_topics(spark, folder)[1]


def _stream_dead(spark, folder):
    return _streamed(spark, folder)[1].read(spark).select("original_payload", "error", "topic", "table", "partition", "offset")


BY_HALF = f"""CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 'early' ELSE 'late' END AS topic"""
ORDER_MESSAGE_SQL = f"""SELECT 'changes.orders' AS topic, CAST(o_orderkey AS VARCHAR) AS key, {JSON_ORDER} AS value,
  'source_table' AS header_key, 'orders' AS header_value FROM orders"""

QUERIES = {
    "pull_once": Query(_pull_once, f"{ORDER_MESSAGE_SQL} WHERE o_orderdate < TIMESTAMP '1998-01-01'"),
    "file_log_round_trip": Query(
        _round_trip,
        """WITH pulled AS (
             SELECT *, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 4 AS VARCHAR) AS p
             FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
           ), placed AS (
             SELECT *, md5('changes.orders|' || p || '|' || (row_number() OVER (PARTITION BY p ORDER BY o_orderdate, o_orderkey) - 1)) AS id
             FROM pulled
           )
           SELECT id, unnest(['o_orderkey', 'o_orderstatus', 'o_orderdate']) AS field,
             unnest([CAST(o_orderkey AS VARCHAR), o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')]) AS val
           FROM placed""",
    ),
    "pull_once_progress": Query(
        _pull_progress,
        """SELECT * FROM (SELECT 'orders' AS "table", o_orderdate AS ts, CAST(o_orderkey AS VARCHAR) AS last_identifier
             FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
             ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
           UNION ALL SELECT 'customer', NULL, NULL""",
    ),
    "stream_publish": Query(_stream_publish, ORDER_MESSAGE_SQL),
    "stream_apply": Query(
        _stream_apply, APPLIED.replace("'customers.' || event_type AS topic", "'customers' AS topic")
    ),
    "stream_apply_two_topics": Query(
        _two_topics_applied, APPLIED.replace("'customers.' || event_type AS topic", BY_HALF)
    ),
    "stream_dead_two_topics": Query(
        _two_topics_dead,
        f"""WITH p AS ({PARSED.replace("'customers.' || event_type AS topic", BY_HALF)})
            SELECT topic, count(*) AS letters FROM ({FAILED}) GROUP BY topic""",
    ),
    "stream_dead_letters": Query(
        _stream_dead,
        f"""WITH p AS ({PARSED}) SELECT value AS original_payload, reason AS error, 'customers' AS topic,
              'customers' AS "table", partition, "offset" FROM ({FAILED})""",
    ),
}
