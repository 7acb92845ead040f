"""Stored progress of each table.

The store is a small parquet table partitioned by table and slot.  A flush writes
one row into the next slot of its table, so the row before it stays readable until
the new one is in place, writers of different tables never touch the same folder,
and the number of files stays fixed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.timestamps import naive_utc
from tideline.specs import Progress, TableSpec

SLOTS = 8
PROGRESS_SCHEMA = "ts timestamp_ntz, last_identifier string, version bigint, table string, slot int"


def create_if_missing(spark: SparkSession, path: str, schema: str, *partition_by: str) -> None:
    """An empty partitioned table, so that readers need not care who comes first."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partition_by).parquet(path)


class ProgressStore:
    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path
        self._pending: dict[str, Progress] = {}
        create_if_missing(spark, path, PROGRESS_SCHEMA, "table", "slot")

    def _slots(self) -> DataFrame:
        return self._spark.read.schema(PROGRESS_SCHEMA).parquet(self._path)

    def stored(self) -> DataFrame:
        """The newest ``(table, ts, last_identifier, version)`` of each table."""
        newest = F.max_by(F.struct("ts", "last_identifier", "version"), "version").alias("p")
        return self._slots().groupBy("table").agg(newest).select("table", "p.*")

    def load(self, specs: Iterable[TableSpec]) -> DataFrame:
        """One row per spec; a table without progress has NULLs."""
        names = self._spark.createDataFrame([(s.name,) for s in specs], "table string")
        return names.join(self.stored(), "table", "left")

    def _row(self, table: str):
        return self._slots().where(F.col("table") == table).orderBy(F.desc("version")).first()

    def get(self, table: str) -> Progress:
        if table in self._pending:
            return self._pending[table]
        row = self._row(table)
        return Progress(row["ts"], row["last_identifier"] or "") if row else Progress()

    def set(self, table: str, progress: Progress) -> None:
        ts = naive_utc(progress.ts) if progress.ts else None
        self._pending[table] = Progress(ts, progress.last_identifier)

    def flush(self, *tables: str) -> int:
        """Write what changed since the last flush, of ``tables`` or of all; returns how many did.

        Jobs of different tables may share a store, each flushing its own.
        """
        written = 0
        for table in tables or list(self._pending):
            progress = self._pending.get(table)
            if progress is not None:
                written += self._write(table, progress)
                del self._pending[table]
        return written

    def _write(self, table: str, progress: Progress) -> bool:
        row = self._row(table)
        if row and Progress(row["ts"], row["last_identifier"] or "") == progress:
            return False
        version = row["version"] + 1 if row else 1
        values = [(progress.ts, progress.last_identifier, version, table, version % SLOTS)]
        (
            self._spark.createDataFrame(values, PROGRESS_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("table", "slot")
            .parquet(self._path)
        )
        return True

    def snapshot(self) -> dict[str, Progress]:
        """Progress of every table, with changes not yet flushed; one entry per table."""
        rows = {r["table"]: Progress(r["ts"], r["last_identifier"] or "") for r in self.stored().collect()}
        return {**rows, **self._pending}
