"""Continuous pulls and applies as Structured Streaming queries.

Each table or topic has its own query and checkpoint, so a slow one holds up no
other.  A batch that fails is run again under the same id after a restart.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.predicates import Clause
from tideline.operators.reads import project
from tideline.plans.apply import apply_batch
from tideline.plans.pull import publish_rows, pull_once
from tideline.sinks.targets import DeadLetterTable, RecordTable
from tideline.sources.progress import ProgressStore
from tideline.specs import DEFAULT_INITIAL_HOURS, DEFAULT_SLOW_INTERVAL, ApplySpec, PullSettings, TableSpec

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _start(writer, name: str, checkpoint: str, trigger: dict[str, Any]) -> StreamingQuery:
    return writer.queryName(name).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_publish(
    rows: DataFrame,
    spec: TableSpec,
    store: ProgressStore,
    sink: Any,
    checkpoint: str,
    *,
    settings: PullSettings = PullSettings(),
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Publish a stream of changed rows, such as files that land in a folder.

    The stream's checkpoint decides what is new; stored progress follows each
    published batch, but not to an earlier timestamp.  Settings that limit what
    a pull reads have no meaning here and raise.
    """
    if settings.delay_seconds or settings.batch_size or settings.initial_hours != DEFAULT_INITIAL_HOURS:
        raise ValueError("a stream takes no delay_seconds, batch_size or initial_hours")

    def publish(batch: DataFrame, batch_id: int) -> None:
        due = project(batch.where(Clause().is_not_empty(spec.id_col).on(batch)), spec)
        previous = store.get(spec.name)
        result = publish_rows(due, spec, sink, f"{spec.name}-{batch_id}", previous, settings)
        older = previous.ts and result.progress.ts and result.progress.ts < previous.ts
        if result.rows and not older:
            store.set(spec.name, result.progress)
            store.flush(spec.name)

    return _start(
        rows.writeStream.foreachBatch(publish), f"publish-{spec.name}", checkpoint, trigger or {"availableNow": True}
    )


def poll_table(
    spark: SparkSession,
    load: Callable[[], DataFrame],
    spec: TableSpec,
    store: ProgressStore,
    sink: Any,
    checkpoint: str,
    *,
    settings: PullSettings = PullSettings(),
    interval: str = DEFAULT_SLOW_INTERVAL,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Pull a table that has no change stream again and again.

    A one-row-per-second stream gives the rhythm; each trigger reads the table
    anew with ``load`` and publishes the whole backlog.
    """

    def run(_: DataFrame, __: int) -> None:
        pull_once(load(), spec, store, sink, now=clock(), settings=settings)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return _start(ticks.writeStream.foreachBatch(run), f"poll-{spec.name}", checkpoint, {"processingTime": interval})


def stream_apply(
    log: DataFrame,
    topic: str,
    target: RecordTable,
    spec: ApplySpec,
    checkpoint: str,
    *,
    dead: DeadLetterTable | None = None,
    metrics_path: str | None = None,
    trigger: dict[str, Any] | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Apply the messages of one topic to its target.

    Several topics may share a target, dead letters and metrics.  Batches are
    named by topic and by the id that Spark keeps in the checkpoint, so a new
    checkpoint does not write over the batches of the one before.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the id of the streaming query is not known")
        source = f"{topic}-{query}"
        apply_batch(
            batch, batch_id, target, spec, now=clock(), dead=dead, metrics_path=metrics_path, source=source
        )

    mine = log.where(F.col("topic") == topic)
    return _start(
        mine.writeStream.foreachBatch(run), f"apply-{spec.table}-{topic}", checkpoint, trigger or {"availableNow": True}
    )
