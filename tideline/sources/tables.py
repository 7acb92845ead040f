"""Source tables: parquet or other files, JDBC, and landed API responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_RECORD = "map<string,string>"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_col: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``partitions`` parallel range queries on ``split_col``.

    The range only divides the work; rows outside it belong to the first and the
    last query.  Filters of a pull are pushed to the database.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .options(partitionColumn=split_col, lowerBound=lower, upperBound=upper, numPartitions=partitions)
        .load()
    )


def read_envelopes(spark: SparkSession, path: str, record: str | T.StructType = RESULT_RECORD) -> DataFrame:
    """Records of landed ``{"result": [...]}`` responses, one response per file.

    ``record`` is a struct type for typed columns, else each record is a map.
    """
    ddl = record.simpleString() if isinstance(record, T.StructType) else record
    landed = spark.read.schema(f"result array<{ddl}>").json(path, multiLine=True)
    return _records(landed, F.col("result"))


def decode_envelopes(df: DataFrame, body: str, record: str | T.StructType = RESULT_RECORD) -> DataFrame:
    """The same for responses held in a text column; an empty result gives no rows."""
    ddl = record.simpleString() if isinstance(record, T.StructType) else record
    return _records(df, F.from_json(F.col(body), f"struct<result: array<{ddl}>>")["result"])


def _records(df: DataFrame, result: Column) -> DataFrame:
    rows = df.select(F.explode(result).alias("record"))
    return rows.select("record.*") if isinstance(rows.schema["record"].dataType, T.StructType) else rows
