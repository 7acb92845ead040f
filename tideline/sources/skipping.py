"""Pulls from folders of Parquet files that open only the files that can hold due rows.

For tables without a partition column to prune by.  The smallest and largest timestamp of each file are kept in a
small table; a file is read for them once, when it is new or was written again.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timestamps import position_ts
from tideline.operators.incremental import bounds, pull
from tideline.sources.progress import create_if_missing
from tideline.specs import Progress, TableSpec

RANGE_SCHEMA = "file string, modified timestamp, low timestamp_ntz, high timestamp_ntz, n bigint, part string"


def _same(path: str | Column) -> Column:
    """A path in one spelling: Spark names a local file with one slash or with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _decoded(path: str) -> Column:
    """The path behind ``_metadata.file_path``, which is a URL; a plus stands for itself there."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


class FileRanges:
    """The range of ``spec.ts_col`` in each file below ``folder``, kept under ``path``."""

    def __init__(self, spark: SparkSession, folder: str, spec: TableSpec, path: str):
        self._spark, self._folder, self._spec, self._path = spark, folder, spec, path
        create_if_missing(spark, path, RANGE_SCHEMA, "part")

    def _listed(self) -> DataFrame:
        """Names and times of the files; their content is not read."""
        files = self._spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        found = files.option("recursiveFileLookup", "true").load(self._folder)
        return found.select("path", F.col("modificationTime").alias("modified"), _same("path").alias("file"))

    def _known(self) -> DataFrame:
        return self._spark.read.schema(RANGE_SCHEMA).parquet(self._path)

    def _table(self, files: list[str], schema: T.StructType | None = None) -> DataFrame:
        reader = self._spark.read if schema is None else self._spark.read.schema(schema)
        return reader.option("recursiveFileLookup", "true").parquet(*(files or [self._folder]))

    def refresh(self) -> int:
        """Add the files not known yet; returns how many.  Reads one column of them."""
        fresh = [r["path"] for r in self._listed().join(self._known(), ["file", "modified"], "left_anti").collect()]
        if not fresh:
            return 0
        rows = self._table(fresh)
        dtype = rows.schema[self._spec.ts_col].dataType
        if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            raise TypeError(f"{self._spec.ts_col} is no timestamp")
        ts = position_ts(self._spec.ts_col, dtype, "micros")
        place = rows.select(
            _same(_decoded("_metadata.file_path")).alias("file"), F.col("_metadata.file_modification_time").alias("modified"), ts.alias("ts")
        )
        ranges = place.groupBy("file", "modified").agg(
            F.min("ts").cast("timestamp_ntz").alias("low"), F.max("ts").cast("timestamp_ntz").alias("high"), F.count("*").alias("n")
        )
        ranges.withColumn("part", F.lit(uuid.uuid4().hex)).write.mode("append").partitionBy("part").parquet(self._path)
        return len(fresh)

    def due_files(self, progress: Progress | None, now: datetime, delay_seconds: int = 0, initial_hours: int = -1) -> list[str]:
        """The files a pull must open: those with due rows and those not known yet."""
        window = bounds(progress, now, delay_seconds, initial_hours)
        ranges = self._known().dropDuplicates(["file", "modified"])
        files = self._listed().join(ranges, ["file", "modified"], "left")
        holds = F.col("low") < F.lit(window.through).cast("timestamp_ntz")
        if window.first is not None:
            holds &= F.col("high") >= F.lit(window.first.replace(microsecond=0)).cast("timestamp_ntz")
        return [r["path"] for r in files.where(F.col("n").isNull() | holds).select("path").distinct().collect()]

    def pull(self, progress: Progress | None = None, *, now: datetime, limit: int | None = None, **window: int) -> DataFrame:
        """What ``pull`` gives for the whole folder, from the due files alone.

        The list of files comes to the driver, as it does for every scan of files.
        """
        schema = self._table([]).schema
        files = self.due_files(progress, now, **window)
        rows = self._table(files, schema) if files else self._spark.createDataFrame([], schema)
        return pull(rows, self._spec, progress, now=now, limit=limit, **window)
