"""Small helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def remainder(key: str | Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; of a null key, of the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % divisor


BATCH_SETTING, SPARK_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and hand them batches that fit for rows with whole texts.

    On a cluster whose machines do not share that path, submit the package with --py-files.  A batch size that the user has
    set stays.
    """
    if spark.conf.get(BATCH_SETTING) == SPARK_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def map_batches(df: DataFrame, schema: str | StructType, build: Callable[[pa.RecordBatch], dict | None]) -> DataFrame:
    """One output batch for each Arrow batch: ``build`` gives its columns by name."""
    names = schema.names if isinstance(schema, StructType) else [x.split()[0] for x in schema.split(", ")]
    importable(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := build(batch)) is not None:
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)], names=names)

    return df.mapInArrow(run, schema)


def with_columns(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` with the columns ``added``, given as DDL, behind its own."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])


def plain_names(df: DataFrame, *roles: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns called c0, c1, ..., and what those named in ``roles`` are called now.

    So no column of the user's can clash with one that an operator adds, or need quotes.
    """
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))), [f"c{df.columns.index(r)}" for r in roles]
