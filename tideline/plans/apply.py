"""Log to table as a batch job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.payload import insert_id
from tideline.operators.apply import (
    dead_letters,
    fold_patches,
    merge_patches,
    named_ids,
    new_rows,
    parse_log,
    rejected_updates,
    unknown_ids,
)
from tideline.operators.metrics import tagged
from tideline.session import small_side, stage
from tideline.sinks.targets import DeadLetterTable, ExternalTable, RecordTable, write_batch
from tideline.specs import ApplySpec


class PartialFailure(RuntimeError):
    """Some messages of a batch could not be applied and the policy is not to pass over them."""


@dataclass(frozen=True)
class Changes:
    """What a batch does to its target."""

    inserts: DataFrame
    patches: DataFrame
    failed: DataFrame


def missing_ids(parsed: DataFrame, ids: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    """Ids that updates of a parsed batch name and neither the target nor its new rows hold.

    New rows count, so an update may follow its insert in one batch.  Frames
    persisted on the way are added to ``held``; without it nothing is persisted
    and Spark decides on the joins alone.
    """
    named = named_ids(parsed.where(F.col("operation") == "update"))
    if held is not None:
        held.append(named.persist(StorageLevel.MEMORY_AND_DISK))
        named = small_side(named, "id")
    return unknown_ids(named, ids, new_rows(parsed))


def touched_ids(parsed: DataFrame) -> DataFrame:
    """``(id, named, new)``: each id of a parsed batch once, whether updates name it and whether it is that of a new row."""
    added = F.col("operation") == "insert"
    place = F.when(added, insert_id("topic", "partition", "offset")).otherwise(F.col("id"))
    known = parsed.where(F.col("operation") != "reject").select(place.alias("id"), added.alias("added"))
    return known.groupBy("id").agg(F.bool_or(~F.col("added")).alias("named"), F.bool_or("added").alias("new"))


def judge_ids(parsed: DataFrame, ids: DataFrame, held: list[DataFrame]) -> DataFrame:
    """``touched_ids`` with ``known``, whether the target holds the id, in one look at the target.

    A few ids are broadcast, so that a large target is not shuffled.  Persisted, like what is added to ``held``.
    """
    touched = touched_ids(parsed).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(touched)
    found = ids.join(small_side(touched.select("id"), "id"), "id", "left_semi").distinct()
    judged = touched.join(found.withColumn("known", F.lit(True)), "id", "left").na.fill(False, ["known"])
    held.append(judged.persist(StorageLevel.MEMORY_AND_DISK))
    return judged


def only_new(inserts: DataFrame, judged: DataFrame) -> DataFrame:
    """``inserts`` without rows that the target holds; mostly there are none, and the rows stay where they are."""
    if judged.where(F.col("new") & F.col("known")).isEmpty():
        return inserts
    fresh = judged.where(F.col("new") & ~F.col("known")).select("id")
    return inserts.join(small_side(fresh, "id"), "id", "left_semi")


def plan_changes(parsed: DataFrame, unknown: DataFrame, spec: ApplySpec) -> Changes:
    """Split a parsed batch into inserts, one folded patch per known id, and failures."""
    updates = parsed.where(F.col("operation") == "update")
    rejects = parsed.where(F.col("operation") == "reject")
    return Changes(
        inserts=new_rows(parsed),
        patches=fold_patches(updates, fields=spec.fields).join(unknown, "id", "left_anti"),
        failed=rejects.unionByName(rejected_updates(updates, unknown)),
    )


def apply_log(log: DataFrame, target: DataFrame, spec: ApplySpec) -> tuple[DataFrame, DataFrame]:
    """The target after ``log`` and the messages that failed.

    The log is parsed once into the scratch folder: parsing costs more than all
    that follows, and a filter on its result would otherwise repeat it.
    """
    parsed = stage(parse_log(log, spec.id_field), "parsed")
    changes = plan_changes(parsed, missing_ids(parsed, target), spec)
    rows = target.unionByName(changes.inserts)
    return merge_patches(rows, changes.patches), changes.failed


def batch_counters(parsed: DataFrame, failed: DataFrame, table: str) -> DataFrame:
    """Counters of one batch: messages by operation less those that failed, and failures."""
    every = parsed.where(F.col("operation") != "reject").groupBy("operation").agg(F.count("*").alias("n"))
    lost = failed.where(F.col("operation") != "reject").groupBy("operation").agg((-F.count("*")).alias("n"))
    named = F.lit(table).alias("table")
    applied = every.unionByName(lost).groupBy("operation").agg(F.sum("n").alias("value")).select(named, "*")
    errors = failed.groupBy(named, F.lit("write").alias("error_type")).agg(F.count("*").alias("value"))
    return tagged("sink_records_total", applied, "operation").unionByName(
        tagged("sink_errors_total", errors, "error_type")
    )


def apply_batch(
    log: DataFrame,
    batch_id: int,
    target: RecordTable | ExternalTable,
    spec: ApplySpec,
    *,
    now: datetime,
    dead: DeadLetterTable | None = None,
    metrics_path: str | None = None,
    source: str | None = None,
) -> int:
    """Apply one batch of messages; returns how many failed.

    ``source`` names what numbers the batches, by default the table; batches of
    different sources never replace each other.  A new row that the target
    already holds, as after a new checkpoint, is not inserted again.

    With ``commit_on_partial_failure`` failures go to ``dead``, if there is one,
    and the batch counts as done.  Without it the rest is applied and the batch
    raises, to be read again; its writes then replace themselves.
    """
    source = source or spec.table
    target.accept(batch_id, source)
    held = [parse_log(log, spec.id_field).persist(StorageLevel.MEMORY_AND_DISK)]
    parsed = held[0]
    try:
        ids = target.ids(before=batch_id, source=source)
        judged = judge_ids(parsed, ids, held)
        unknown = judged.where(F.col("named") & ~F.col("new") & ~F.col("known")).select("id")
        changes = plan_changes(parsed, small_side(unknown, "id"), spec)
        inserts = only_new(changes.inserts, judged)
        failed = changes.failed.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(failed)
        failures = failed.count()
        if dead is not None:
            dead.write(dead_letters(failed, spec.table, now), batch_id, source)
        if metrics_path is not None:
            write_batch(batch_counters(parsed, failed, spec.table), metrics_path, batch_id, source)
        # last: writing to the target makes Spark drop what it holds of plans that read it
        target.write_changes(inserts, changes.patches, batch_id, source, now)
    finally:
        for df in held:
            df.unpersist()
    if failures and not spec.commit_on_partial_failure:
        raise PartialFailure(f"{failures} messages of batch {batch_id} could not be applied to {spec.table}")
    return failures
