"""Targets that changes are applied to, and the tables beside them.

Every write is keyed by source and batch id, a source being one log read under
one checkpoint, and replaces what an earlier try of that batch left.  A replayed
batch changes nothing, and sources that share a table do not touch each other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tideline.functions.timestamps import naive_utc
from tideline.operators.apply import fold_patches, merge_patches
from tideline.operators.messages import limit_writers
from tideline.sources.progress import ProgressStore, create_if_missing
from tideline.specs import DEFAULT_WRITE_PARALLELISM, Progress

RECORD_SCHEMA = "id string, rec map<string,string>"
BASE_SCHEMA = f"{RECORD_SCHEMA}, version bigint"
CHANGE_SCHEMA = f"{RECORD_SCHEMA}, kind string, applied timestamp_ntz, source string, batch_id bigint"
CHANGE_ORDER = ("applied", "batch_id", "source")
DEAD_SCHEMA = (
    "original_payload string, error string, timestamp string, topic string, table string, "
    "partition int, offset bigint, source string, batch_id bigint"
)


def write_batch(df: DataFrame, path: str, batch_id: int, source: str) -> None:
    """Write ``df`` as the whole content of ``batch_id`` of ``source``."""
    (
        df.withColumn("source", F.lit(source))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "batch_id")
        .parquet(path)
    )


class DeadLetterTable:
    def __init__(self, path: str):
        self.path = path

    def write(self, letters: DataFrame, batch_id: int, source: str) -> None:
        write_batch(letters, self.path, batch_id, source)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(DEAD_SCHEMA).parquet(self.path)


def _by_kind(inserts: DataFrame, patches: DataFrame) -> DataFrame:
    return inserts.select("id", "rec", F.lit("insert").alias("kind")).unionByName(
        patches.select("id", "rec", F.lit("patch").alias("kind"))
    )


class ExternalTable:
    """A target behind an interface of its own, written by a bounded number of tasks.

    ``send`` gets an iterator of ``(id, rec, kind)`` rows in each task and must
    accept the same row twice; ``known`` gives a DataFrame with the ids held.
    """

    def __init__(
        self,
        known: Callable[[], DataFrame],
        send: Callable[[Iterator[Row]], None],
        writers: int = DEFAULT_WRITE_PARALLELISM,
    ):
        self._known = known
        self._send = send
        self._writers = writers

    def accept(self, batch_id: int, source: str) -> None:
        """Every batch may be sent again."""

    def ids(self, before: int | None = None, source: str | None = None) -> DataFrame:
        return self._known().select("id")

    def write_changes(
        self, inserts: DataFrame, patches: DataFrame, batch_id: int, source: str, applied: datetime
    ) -> None:
        limit_writers(_by_kind(inserts, patches), self._writers).foreachPartition(self._send)


class RecordTable:
    """A target kept as a base plus the changes of the batches after it.

    Applying a batch writes only its own inserts and folded patches; the base is
    rewritten by ``compact`` alone, which may run as rarely as reading allows.
    Batches count in the order in which they were applied, those applied at the
    same instant by number.  The last batch of each source that a base includes
    is kept in a small table and moves only after the base is complete.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._base = f"{path}/base"
        self._changes = f"{path}/changes"
        self._versions = ProgressStore(spark, f"{path}/version")
        create_if_missing(spark, self._base, BASE_SCHEMA, "version")
        create_if_missing(spark, self._changes, CHANGE_SCHEMA, "source", "batch_id")

    def _state(self) -> tuple[int, dict[str, int]]:
        """The version of the base and the last batch of each source in it."""
        stored = self._versions.get("base").last_identifier
        state = json.loads(stored) if stored else {"version": -1, "included": {}}
        return state["version"], state["included"]

    @property
    def included(self) -> dict[str, int]:
        """The last batch of each source included in the base."""
        return self._state()[1]

    @property
    def compacted(self) -> int:
        """The last batch included in the base, of any source; -1 for none."""
        return max(self.included.values(), default=-1)

    def create(self, records: DataFrame) -> None:
        self._write_base(records, {})

    def _write_base(self, records: DataFrame, included: Mapping[str, int]) -> None:
        version = self._state()[0] + 1
        (
            records.select("id", "rec", F.lit(version).cast("bigint").alias("version"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("version")
            .parquet(self._base)
        )
        state = json.dumps({"version": version, "included": dict(included)}, sort_keys=True)
        self._versions.set("base", Progress(None, state))
        self._versions.flush()

    def _waiting(self, included: Mapping[str, int]) -> DataFrame:
        """Changes that the base does not include."""
        changes = self._spark.read.schema(CHANGE_SCHEMA).parquet(self._changes)
        for source, last in included.items():
            changes = changes.where((F.col("source") != source) | (F.col("batch_id") > last))
        return changes

    def _parts(self, chosen: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """The rows held, inserted ones included, and the patches on them."""
        version, included = self._state()
        base = self._spark.read.schema(BASE_SCHEMA).parquet(self._base).where(F.col("version") == version)
        changes = chosen(self._waiting(included))
        inserted = changes.where(F.col("kind") == "insert").select("id", "rec")
        return base.select("id", "rec").unionByName(inserted), changes.where(F.col("kind") == "patch")

    @staticmethod
    def _before(before: int | None, source: str | None) -> Callable[[DataFrame], DataFrame]:
        if before is None:
            return lambda changes: changes
        earlier = F.col("batch_id") < before
        return lambda changes: changes.where(earlier if source is None else earlier | (F.col("source") != source))

    def accept(self, batch_id: int, source: str) -> None:
        """Raise for a batch that the base includes: its changes would never be read."""
        last = self.included.get(source, -1)
        if batch_id <= last:
            raise ValueError(f"batch {batch_id} of {source!r} is at or before batch {last}, which is compacted")

    def ids(self, before: int | None = None, source: str | None = None) -> DataFrame:
        """Ids held before a batch of ``source``; reads no record."""
        return self._parts(self._before(before, source))[0].select("id")

    @staticmethod
    def _merged(parts: tuple[DataFrame, DataFrame]) -> DataFrame:
        return merge_patches(parts[0], fold_patches(parts[1], order=CHANGE_ORDER))

    def read(self, before: int | None = None, source: str | None = None) -> DataFrame:
        """All rows, with the changes of every batch or of those before ``before``.

        ``source`` limits ``before`` to the batches of one source.
        """
        return self._merged(self._parts(self._before(before, source)))

    def write_changes(
        self, inserts: DataFrame, patches: DataFrame, batch_id: int, source: str, applied: datetime
    ) -> None:
        self.accept(batch_id, source)
        at = F.lit(naive_utc(applied).isoformat(sep=" ")).cast("timestamp_ntz").alias("applied")
        write_batch(_by_kind(inserts, patches).select("*", at), self._changes, batch_id, source)

    def compact(self, through: int | Mapping[str, int]) -> None:
        """Include batches in the base; only for finished batches.

        ``through`` names the last batch of each source, a number that of every
        source.  A change left out must not precede one taken in: that raises.
        """
        included = self.included
        waiting = self._waiting(included)
        if isinstance(through, int):
            through = {r.source: through for r in waiting.select("source").distinct().collect()}
        later = {s: b for s, b in through.items() if b > included.get(s, -1)}
        if not later:
            return
        taken = F.lit(False)
        for source, last in later.items():
            taken = taken | ((F.col("source") == source) & (F.col("batch_id") <= last))
        place = F.struct(*CHANGE_ORDER)
        edge = waiting.agg(F.max(F.when(taken, place)).alias("last"), F.min(F.when(~taken, place)).alias("next"))
        if edge.where("next < last").count():
            raise ValueError("a change applied earlier would be left out of the base")
        self._write_base(self._merged(self._parts(lambda changes: changes.where(taken))), {**included, **later})
