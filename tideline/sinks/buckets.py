"""Targets laid out by id with Spark's own bucketing, so that a batch reads what its ids may lie in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.apply import merge_patches, named_ids, new_rows, parse_log, unknown_ids
from tideline.plans.apply import plan_changes
from tideline.session import stage
from tideline.specs import ApplySpec

LITERALS = 1000
"""A batch with at most so many ids names them in the filter of the scan; beyond that it is joined."""


class BucketedTable:
    """``(id, rec)`` rows in a catalog table, bucketed and sorted by id; ids do not repeat.

    Give it at least as many buckets as ``spark.sql.shuffle.partitions``: with fewer Spark prefers to shuffle both sides of a join.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 200):
        self._spark, self.name, self._buckets = spark, name, buckets

    def create(self, records: DataFrame, path: str | None = None) -> None:
        """Write ``records`` as the table, one file a bucket, under ``path`` or in the warehouse; an existing table raises."""
        laid = records.select("id", "rec").repartition(self._buckets, "id")
        writer = laid.write.bucketBy(self._buckets, "id").sortBy("id")
        (writer.option("path", path) if path else writer).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self._spark.table(self.name)

    def holding(self, named: DataFrame) -> DataFrame:
        """Rows whose id is in ``named``.

        A few ids are put into the filter, by which Spark opens only their buckets; at most ``LITERALS`` + 1 of them come to the
        driver.  More are joined bucket by bucket: ``named`` is shuffled to the table's buckets, the table stays where it lies.
        """
        ids = named.select("id").where(F.col("id").isNotNull()).distinct()
        few = [r["id"] for r in ids.limit(LITERALS + 1).collect()]
        if len(few) <= LITERALS:
            return self.read().where(F.col("id").isin(few))
        return self.read().join(ids.hint("merge"), "id", "left_semi")

    def after(self, changed: DataFrame) -> DataFrame:
        """All rows, those in ``changed`` in place of the old ones; the table is not shuffled."""
        new = changed.select("id", F.struct("rec").alias("new")).hint("merge")
        whole = self.read().join(new, "id", "full")
        return whole.select("id", F.when(F.col("new").isNull(), F.col("rec")).otherwise(F.col("new.rec")).alias("rec"))


def apply_to_buckets(log: DataFrame, target: BucketedTable, spec: ApplySpec) -> tuple[DataFrame, DataFrame]:
    """Records that ``log`` adds or changes, as they are after it, and the messages that failed.

    Reads of ``target`` only the buckets that the ids of the batch fall in.  A message without identifier whose row
    the target already holds, as after a replay, adds nothing.
    """
    parsed = stage(parse_log(log, spec.id_field), "parsed")
    named = named_ids(parsed.where(F.col("operation") == "update"))
    added = new_rows(parsed)
    held = stage(target.holding(named.unionByName(added.select("id"))), "held")
    changes = plan_changes(parsed, unknown_ids(named, held, added), spec)
    fresh = changes.inserts.dropDuplicates(["id"]).join(held.select("id"), "id", "left_anti")
    touched = held.join(changes.patches.select("id"), "id", "left_semi")
    return merge_patches(touched.unionByName(fresh), changes.patches), changes.failed
