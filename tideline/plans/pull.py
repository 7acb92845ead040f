"""Table to log as batch jobs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.functions.keys import message_key
from tideline.operators.incremental import processing_order, progress_columns, pull
from tideline.operators.messages import colocate, contiguous, to_messages
from tideline.sources.progress import ProgressStore
from tideline.specs import Progress, PullSettings, TableSpec


@dataclass(frozen=True)
class PullResult:
    table: str
    rows: int
    progress: Progress


def publish_rows(
    rows: DataFrame, spec: TableSpec, sink: Any, batch: str, previous: Progress, settings: PullSettings
) -> PullResult:
    """Publish ``rows`` and return the position after them.

    The position is observed by the publishing job itself, so it belongs to the
    rows that were written even if the source changes meanwhile.
    """
    if settings.placement != "as_read":
        place = colocate if settings.placement == "colocated" else contiguous
        keyed = rows.withColumn("_key", message_key(rows.schema, spec))
        rows = place(keyed, "_key", [spec.ts_col, spec.id_col]).drop("_key")
    seen = Observation(f"{spec.name}-{batch}")
    ts, ident = progress_columns(rows.schema, spec, settings.progress_mode)
    observed = rows.observe(seen, ts.alias("ts"), ident.alias("id"), F.count("*").alias("rows"))
    order = processing_order(rows.schema, spec) if getattr(sink, "takes_order", False) else ()
    sink.publish(to_messages(observed, spec, settings.topic_prefix, settings.header, order), batch)
    last = seen.get
    found = last.get("rows", 0)
    if not found:
        return PullResult(spec.name, 0, previous)
    ts, ident = last.get("ts") or previous.ts, last.get("id")
    return PullResult(spec.name, found, Progress(ts, previous.last_identifier if ident is None else ident))


def pull_id(spec: TableSpec, progress: Progress) -> str:
    """Name of the batch that starts at ``progress``: a retry replaces its first try."""
    start = f"{spec.name}|{progress.ts}|{progress.last_identifier}"
    return hashlib.md5(start.encode()).hexdigest()


def pull_once(
    df: DataFrame,
    spec: TableSpec,
    store: ProgressStore,
    sink: Any,
    *,
    now: datetime,
    settings: PullSettings = PullSettings(),
) -> PullResult:
    """Publish what is due and only then move the stored progress.

    Without a batch size the whole backlog is one job.
    """
    progress = store.get(spec.name)
    rows = pull(
        df,
        spec,
        progress,
        now=now,
        delay_seconds=settings.delay_seconds,
        initial_hours=settings.initial_hours,
        limit=settings.batch_size,
    )
    result = publish_rows(rows, spec, sink, pull_id(spec, progress), progress, settings)
    if result.rows:
        store.set(spec.name, result.progress)
        store.flush(spec.name)
    return result


def run_all(spark: SparkSession, jobs: Mapping[str, Callable[[], Any]], parallel: int = 8) -> dict[str, Any]:
    """Run one job per table side by side, each in its own scheduler pool.

    A job that fails does not stop the others; its entry holds the exception.
    """

    def run(name: str) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return jobs[name]()
        except Exception as failure:  # one table's failure is that table's result
            return failure
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(jobs, pool.map(run, jobs)))
