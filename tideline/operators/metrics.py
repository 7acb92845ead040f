"""Counters, histograms, gauges and alerts as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.specs import ERROR_RATE_ALERT_PERCENT, LAG_ALERT_SECONDS, LATENCY_BOUNDS


def counter(df: DataFrame, *labels: str) -> DataFrame:
    """Number of rows by label values."""
    return df.groupBy(*labels).agg(F.count("*").alias("value"))


def tagged(metric: str, counts: DataFrame, label: str | None = None) -> DataFrame:
    """A counter in the common form ``(metric, table, label, value)``."""
    second = F.col(label) if label else F.lit(None).cast("string")
    return counts.select(F.lit(metric).alias("metric"), "table", second.alias("label"), "value")


def source_counters(fetched: DataFrame, produced: DataFrame, errors: DataFrame) -> DataFrame:
    """Records fetched by table, produced by table and topic, errors by table and type."""
    return (
        tagged("source_records_total", counter(fetched, "table"))
        .unionByName(tagged("source_produce_total", counter(produced, "table", "topic"), "topic"))
        .unionByName(tagged("source_errors_total", counter(errors, "table", "error_type"), "error_type"))
    )


def sink_counters(applied: DataFrame, errors: DataFrame) -> DataFrame:
    """Records applied by table and operation, errors by table and type."""
    return tagged("sink_records_total", counter(applied, "table", "operation"), "operation").unionByName(
        tagged("sink_errors_total", counter(errors, "table", "error_type"), "error_type")
    )


def api_counters(calls: DataFrame) -> DataFrame:
    """Requests by method and endpoint, errors by method and status, from one pass over ``calls``."""
    by_call = calls.groupBy("method", "endpoint", "status_code").agg(F.count("*").alias("n")).select(
        "n",
        F.explode(
            F.array(
                F.struct(F.lit("api_requests_total").alias("metric"), "method", F.col("endpoint").alias("label")),
                F.struct(
                    F.lit("api_errors_total").alias("metric"), "method", F.col("status_code").cast("string").alias("label")
                ),
            )
        ).alias("c"),
        (outcome_class("status_code") != "ok").alias("failed"),
    )
    counted = by_call.where(F.col("failed") | (F.col("c.metric") == "api_requests_total"))
    return counted.groupBy("c.metric", "c.method", "c.label").agg(F.sum("n").alias("value"))


def _bound_text(bound: float) -> str:
    return f"{bound:g}"


def histogram(
    df: DataFrame, value: str, labels: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS
) -> DataFrame:
    """Cumulative counts: one row per label values and bound, with total count and sum.

    The last bound is ``+Inf``.  All bounds are counted by one aggregation.
    """
    counts = [F.count_if(F.col(value) <= bound).alias(f"b{i}") for i, bound in enumerate(bounds)]
    wide = df.groupBy(*labels).agg(*counts, F.count(value).alias("total"), F.sum(value).alias("sum"))
    rows = [
        F.struct(F.lit(_bound_text(bound)).alias("le"), F.col(f"b{i}").alias("cumulative"))
        for i, bound in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("cumulative")))
    return wide.select(*labels, F.col("total").alias("count"), "sum", F.inline(F.array(*rows)))


def outcome_class(status: str) -> Column:
    """What the status of a call leads to."""
    code = F.col(status)
    return (
        F.when((code >= 200) & (code < 300), "ok")
        .when(code == 401, "reauth")
        .when(code == 429, "wait")
        .when(code >= 500, "retry")
        .otherwise("fatal")
    )


def alerts(lag: DataFrame, dead: DataFrame, calls: DataFrame) -> DataFrame:
    """``(alert, subject, value)`` for each table that lags, each dead-letter topic that
    is not empty and each endpoint with too many failed calls.

    ``lag`` is ``(table, lag_seconds)``, ``dead`` has ``topic``, ``calls`` has
    ``endpoint`` and ``status_code``.
    """
    lagging = lag.where(F.col("lag_seconds") > LAG_ALERT_SECONDS).select(
        F.lit("lag").alias("alert"), F.col("table").alias("subject"), F.col("lag_seconds").alias("value")
    )
    filled = counter(dead, "topic").select(
        F.lit("dead_letters").alias("alert"), F.col("topic").alias("subject"), "value"
    )
    rates = calls.groupBy("endpoint").agg(
        F.count_if(outcome_class("status_code") != "ok").alias("failed"), F.count("*").alias("total")
    )
    failing = rates.where(F.col("failed") * 100 > F.col("total") * ERROR_RATE_ALERT_PERCENT).select(
        F.lit("error_rate").alias("alert"), F.col("endpoint").alias("subject"), F.col("failed").alias("value")
    )
    return lagging.unionByName(filled).unionByName(failing)
