"""Several sources that know the same records: which value counts, and what a person must decide.

Records are ``(id, rec)`` as in ``apply``.  All rules work on one row per field and group by ``(id, field)``, which
combines in each map task first; no source is joined to another.  A field that a record does not have differs
from one that it sets to NULL: only the second is a value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.apply import LOG_ORDER, by_fields, fields_of, record_fields
from tideline.session import stage
from tideline.sources.progress import create_if_missing

ENTRY_SCHEMA = "entry string, id string, field string, base string, ours string, theirs string, run bigint"
CLOSED_SCHEMA = "entry string, run bigint"


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("at least one source is required")
    return reduce(DataFrame.unionByName, parts)


def field_clocks(updates: DataFrame, order: Sequence[str] = LOG_ORDER) -> DataFrame:
    """``(id, field, val, at)``: each field as last set in ``order``, with the first column of ``order`` as its time.

    A place in ``order`` belongs to one message.  Of several at one place that set the same fields, the one whose values are greater,
    compared by name of field, counts as a whole.
    """
    last = by_fields(updates, order).groupBy("id", "names").agg(F.max(F.struct("at", "vals")).alias("last"))
    rows = fields_of(last.select("id", "names", "last.*").repartition("id"), "id", "at")
    last = rows.groupBy("id", "field").agg(F.max(F.struct("at", "val")).alias("last"))
    return last.select("id", "field", "last.val", F.col("last.at")[order[0]].alias("at"))


def newest_wins(sides: Mapping[str, DataFrame]) -> DataFrame:
    """``(id, field, val, at, side)``: of each field the value with the latest time, and whose it is.

    ``sides`` are ``(id, field, val, at)``.  At one time the side named first counts; a field without a time is older than
    any with one.  If one side gives a field twice at one time, its greater value counts.
    """
    parts = [
        fields.select("id", "field", "val", "at", F.lit(-rank).alias("rank"))
        for rank, (_, fields) in enumerate(sides.items())
    ]
    newest = F.max(F.struct("at", "rank", "val")).alias("newest")  # each value once: the rank tells the side
    found = _united(parts).groupBy("id", "field").agg(newest)
    side = F.array(*map(F.lit, sides))[-F.col("newest.rank")]
    return found.select("id", "field", "newest.val", "newest.at", side.alias("side"))


def system_of_record(sources: Mapping[str, DataFrame], owners: Mapping[str, str] | None = None) -> DataFrame:
    """``(id, field, val, source)``: each field from its owner, else from the first of ``sources`` that has it.

    A source that clears a field decides that it is NULL; one that does not name it leaves it to the next.  If a source
    gives a field of a record twice, its smallest value counts, NULL first.
    """
    owners = dict(owners or {})
    unknown = set(owners.values()) - set(sources)
    if unknown:
        raise ValueError(f"owners that are no sources: {sorted(unknown)}")
    # whole records are shuffled, by id, and cut into fields there
    parts = [records.select("id", "rec", F.lit(number).alias("number")) for number, records in enumerate(sources.values())]
    fields = record_fields(_united(parts).repartition("id"), "number")
    owned = reduce(
        lambda rest, entry: rest | ((F.col("field") == entry[0]) & (F.col("number") == list(sources).index(entry[1]))),
        owners.items(),
        F.lit(False),
    )
    fields = fields.withColumn("rank", F.when(owned, F.lit(-1)).otherwise(F.col("number")))
    chosen = F.min(F.struct("rank", "val", "number")).alias("chosen")
    source = F.array(*map(F.lit, sources))[F.col("chosen.number")]
    return fields.groupBy("id", "field").agg(chosen).select("id", "field", "chosen.val", source.alias("source"))


def differences(base: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``(id, field, base, ours, theirs, state)``: fields that a side has changed since the snapshot ``base``.

    A version is a struct of one value, and NULL where the record does not have the field.  ``state`` is ``ours`` or
    ``theirs`` for a change of one side, ``both`` for the same change on both, and ``conflict``.  If a
    version gives a field of a record twice, its greatest value counts.
    """
    versions = {"base": base, "ours": ours, "theirs": theirs}
    rows = _united([record_fields(df).select("*", F.lit(name).alias("version")) for name, df in versions.items()])
    value = F.struct(F.col("val").alias("val"))
    wide = rows.groupBy("id", "field").agg(
        *[F.max(F.when(F.col("version") == name, value)).alias(name) for name in versions]
    )
    mine, other = ~F.col("ours").eqNullSafe(F.col("base")), ~F.col("theirs").eqNullSafe(F.col("base"))
    state = (
        F.when(mine & other, F.when(F.col("ours").eqNullSafe(F.col("theirs")), "both").otherwise("conflict"))
        .when(mine, "ours")
        .when(other, "theirs")
    )
    return wide.withColumn("state", state).where(F.col("state").isNotNull())


def agreed(changes: DataFrame) -> DataFrame:
    """``(id, field, present, val)``: what ``differences`` settles by itself; a field that goes has ``present`` false."""
    new = F.when(F.col("state") == "theirs", F.col("theirs")).otherwise(F.col("ours"))
    settled = changes.where(F.col("state") != "conflict").select("id", "field", new.alias("new"))
    return settled.select("id", "field", F.col("new").isNotNull().alias("present"), F.col("new.val").alias("val"))


def entries(changes: DataFrame) -> DataFrame:
    """The conflicts among ``differences`` as rows of the review queue; equal conflicts have equal names."""

    def text(version: str) -> Column:
        return F.col(version)["val"].alias(version)

    # a version that has no such field is left out of the JSON, one with a NULL is an empty object
    name = F.md5(F.to_json(F.struct("id", "field", "base", "ours", "theirs"))).alias("entry")
    found = changes.where(F.col("state") == "conflict")
    return found.select(name, "id", "field", text("base"), text("ours"), text("theirs"))


class ReviewQueue:
    """Conflicts that wait for a decision, in a table with one partition a run.

    A run that is made again replaces what it added.  Runs are numbered upwards.  A conflict that
    is open stays one entry however often it is found; one found again after it was closed opens anew.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._entries, self._closed = f"{path}/entries", f"{path}/closed"
        create_if_missing(spark, self._entries, ENTRY_SCHEMA, "run")
        create_if_missing(spark, self._closed, CLOSED_SCHEMA, "run")

    def open(self, before: int | None = None) -> DataFrame:
        """Entries not closed, those of runs before ``before`` if given."""
        added = self._spark.read.schema(ENTRY_SCHEMA).parquet(self._entries)
        closed = self._spark.read.schema(CLOSED_SCHEMA).parquet(self._closed)
        if before is not None:
            added, closed = added.where(F.col("run") < before), closed.where(F.col("run") < before)
        ended = closed.groupBy("entry").agg(F.max("run").alias("ended"))
        waiting = added.join(ended, "entry", "left").where(F.col("ended").isNull() | (F.col("ended") < F.col("run")))
        return waiting.drop("ended")

    def _write(self, rows: DataFrame, path: str, run: int) -> None:
        partitioned = rows.withColumn("run", F.lit(run).cast("bigint")).write.partitionBy("run").mode("overwrite")
        partitioned.option("partitionOverwriteMode", "dynamic").parquet(path)

    def add(self, changes: DataFrame, run: int) -> None:
        """Open an entry for each conflict that earlier runs have not left open."""
        found = entries(changes).join(self.open(before=run).select("entry"), "entry", "left_anti")
        self._write(stage(found, "conflicts"), self._entries, run)

    def close(self, decided: DataFrame, run: int) -> None:
        """Close the entries named in ``decided`` as of ``run``, a run after which they were found."""
        self._write(stage(decided.select("entry").distinct(), "decided"), self._closed, run)
