"""Topics as batch or streaming DataFrames with one column contract.

Every reader returns ``topic, partition, offset, timestamp, value`` with a text
value.  A Kafka topic needs Spark's Kafka connector on the classpath; a folder of
parquet files with these columns serves everywhere else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timestamps import utc_clock
from tideline.specs import DEFAULT_FILES_PER_TRIGGER, DEFAULT_RECORDS_PER_TRIGGER

LOG_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string"


def kafka_options(
    servers: str, topics: Sequence[str], records_per_trigger: int | None = DEFAULT_RECORDS_PER_TRIGGER, **extra: str
) -> dict[str, str]:
    """Reader options: from the earliest offset, in bounded batches.

    A batch costs a few seconds whatever its size, so the bound is high by
    default; a target that takes records one by one may want 100.
    ``extra`` carries connector settings such as ``kafka.security.protocol``.
    """
    if not topics:
        raise ValueError("at least one topic is required")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        **extra,
    }
    if records_per_trigger:
        options["maxOffsetsPerTrigger"] = str(records_per_trigger)
    return options


def _as_log(df: DataFrame) -> DataFrame:
    instant = isinstance(df.schema["timestamp"].dataType, T.TimestampType)
    clock = utc_clock("timestamp") if instant else F.col("timestamp").cast("timestamp_ntz")
    return df.select(
        "topic",
        "partition",
        "offset",
        clock.alias("timestamp"),
        F.col("value").cast("string").alias("value"),
    )


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _as_log(spark.readStream.format("kafka").options(**options).load())


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    batch = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return _as_log(spark.read.format("kafka").options(**batch).load())


def stream_files(spark: SparkSession, path: str, files_per_trigger: int = DEFAULT_FILES_PER_TRIGGER) -> DataFrame:
    return _as_log(
        spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return _as_log(spark.read.schema(LOG_SCHEMA).parquet(path))
