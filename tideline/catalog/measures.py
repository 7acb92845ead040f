"""Counters, histograms, outcome classes and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.catalog.applying import FAILED, PARSED, _apply, _customers, _parsed
from tideline.catalog.base import Query, table
from tideline.operators.incremental import lag_seconds
from tideline.operators.metrics import alerts, api_counters, counter, histogram, outcome_class, source_counters
from tideline.plans.apply import batch_counters, missing_ids, plan_changes
from tideline.specs import POLL_DURATION_BOUNDS, ApplySpec


def api_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a request log: the status follows from the payload, the latency from the value."""
    k = F.get_json_object("props", "$.k").cast("int")
    failing = F.when(F.col("event_type") == "error", 100).otherwise(0)
    return table(spark, folder, "events").select(
        F.when(F.col("event_type").isin("signup", "purchase"), "POST").otherwise("GET").alias("method"),
        F.col("event_type").alias("endpoint"),
        (F.lit(101) + 4 * k + failing).alias("status_code"),
        (F.col("value").cast("decimal(18,6)") / 10).cast("decimal(18,6)").alias("latency_s"),
        F.col("ts").alias("at"),
    )


CALLS = """
  SELECT CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method, event_type AS endpoint,
    101 + 4 * CAST(props->>'k' AS INTEGER) + CASE event_type WHEN 'error' THEN 100 ELSE 0 END AS status_code,
    CAST(CAST(value AS DECIMAL(18,6)) / 10 AS DECIMAL(18,6)) AS latency_s, ts AS "at"
  FROM events"""
CLASSED = f"""
  SELECT *, CASE WHEN status_code >= 200 AND status_code < 300 THEN 'ok' WHEN status_code = 401 THEN 'reauth'
    WHEN status_code = 429 THEN 'wait' WHEN status_code >= 500 THEN 'retry' ELSE 'fatal' END AS class FROM ({CALLS})"""


def _histogram(labels, bounds=None):
    def run(spark, folder):
        extra = {} if bounds is None else {"bounds": bounds}
        found = histogram(api_calls(spark, folder), "latency_s", labels, **extra)
        return found.withColumn("sum", F.col("sum").cast("double"))

    return run


def _histogram_sql(labels: str, bounds) -> str:
    rows = ", ".join(
        f"{{'le': '{b:g}', 'n': count(*) FILTER (WHERE latency_s <= CAST({b} AS DECIMAL(18,6)))}}" for b in bounds
    )
    return f"""
      SELECT {labels}, "count", "sum", f.le AS le, CAST(f.n AS BIGINT) AS cumulative FROM (
        SELECT {labels}, CAST(count(*) AS BIGINT) AS "count", CAST(sum(latency_s) AS DOUBLE) AS "sum",
          [{rows}, {{'le': '+Inf', 'n': count(*)}}] AS steps
        FROM ({CALLS}) GROUP BY {labels}), unnest(steps) AS u(f)"""


def _classes(spark, folder):
    return api_calls(spark, folder).groupBy(outcome_class("status_code").alias("class")).agg(F.count("*").alias("value"))


def _sources(spark, folder):
    events = table(spark, folder, "events")
    fetched = events.select(F.col("event_type").alias("table"))
    produced = events.where(F.col("event_type") != "error").select(
        F.col("event_type").alias("table"), F.concat(F.lit("changes."), "event_type").alias("topic")
    )
    errors = events.where(F.col("event_type") == "error").select(
        F.col("event_type").alias("table"), F.lit("produce").alias("error_type")
    )
    return source_counters(fetched, produced, errors)


def _sinks(spark, folder):
    parsed = _parsed(spark, folder)
    changes = plan_changes(parsed, missing_ids(parsed, _customers(spark, folder)), ApplySpec("customers"))
    return batch_counters(parsed, changes.failed, "customers")


def _alerts(spark, folder):
    calls = api_calls(spark, folder)
    newest = table(spark, folder, "events").withColumnRenamed("event_type", "table")
    lag = lag_seconds(newest, "table", "ts", datetime(2024, 1, 31))
    return alerts(lag, _apply(spark, folder)[1], calls)


BOUNDS = (0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30)

QUERIES = {
    "counters_source": Query(
        _sources,
        """SELECT 'source_records_total' AS metric, event_type AS "table", CAST(NULL AS VARCHAR) AS label,
             CAST(count(*) AS BIGINT) AS value FROM events GROUP BY event_type
           UNION ALL SELECT 'source_produce_total', event_type, 'changes.' || event_type, count(*) FROM events
             WHERE event_type <> 'error' GROUP BY event_type
           UNION ALL SELECT 'source_errors_total', event_type, 'produce', count(*) FROM events
             WHERE event_type = 'error' GROUP BY event_type""",
    ),
    "counters_sink": Query(
        _sinks,
        f"""WITH p AS ({PARSED}), failed AS ({FAILED})
            SELECT 'sink_records_total' AS metric, 'customers' AS "table", operation AS label,
              CAST(count(*) AS BIGINT) AS value FROM p
            WHERE operation <> 'reject' AND "offset" NOT IN (SELECT "offset" FROM failed) GROUP BY operation
            UNION ALL SELECT 'sink_errors_total', 'customers', 'write', count(*) FROM failed""",
    ),
    "counters_api": Query(
        lambda s, f: api_counters(api_calls(s, f)),
        f"""SELECT 'api_requests_total' AS metric, method, endpoint AS label, CAST(count(*) AS BIGINT) AS value
            FROM ({CLASSED}) GROUP BY method, endpoint
            UNION ALL SELECT 'api_errors_total', method, CAST(status_code AS VARCHAR), count(*)
            FROM ({CLASSED}) WHERE class <> 'ok' GROUP BY method, status_code""",
    ),
    "counter_by_label": Query(
        lambda s, f: counter(table(s, f, "lineitem"), "l_returnflag", "l_linestatus"),
        """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS value FROM lineitem
           GROUP BY l_returnflag, l_linestatus""",
    ),
    "histogram_cumulative": Query(_histogram(["method", "endpoint"]), _histogram_sql("method, endpoint", BOUNDS)),
    "histogram_poll_duration": Query(
        _histogram(["endpoint"], POLL_DURATION_BOUNDS), _histogram_sql("endpoint", POLL_DURATION_BOUNDS)
    ),
    "outcome_class": Query(
        _classes, f"SELECT class, CAST(count(*) AS BIGINT) AS value FROM ({CLASSED}) GROUP BY class"
    ),
    "alerts": Query(
        _alerts,
        f"""WITH p AS ({PARSED}), failed AS ({FAILED}),
            lag AS (SELECT event_type, CAST(epoch(TIMESTAMP '2024-01-31') - epoch(date_trunc('second', max(ts)))
              AS BIGINT) AS s FROM events GROUP BY event_type)
            SELECT 'lag' AS alert, event_type AS subject, s AS value FROM lag WHERE s > 300
            UNION ALL SELECT 'dead_letters', topic, CAST(count(*) AS BIGINT) FROM failed GROUP BY topic
            UNION ALL SELECT 'error_rate', endpoint, CAST(count(*) FILTER (WHERE class <> 'ok') AS BIGINT)
            FROM ({CLASSED}) GROUP BY endpoint HAVING count(*) FILTER (WHERE class <> 'ok') * 100 > count(*)""",
    ),
}
