"""Rows to log messages, and where they are placed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.encode import record_json, table_header, topic_name
from tideline.functions.keys import message_key
from tideline.specs import DEFAULT_HEADER, TableSpec


def to_messages(
    df: DataFrame,
    spec: TableSpec,
    topic_prefix: str = "",
    header: str = DEFAULT_HEADER,
    order: Sequence[Column] = (),
) -> DataFrame:
    """``(topic, key, value, headers)``, the columns a log writer takes; with ``order`` one more, to sort by."""
    return df.select(
        topic_name(spec.topic, topic_prefix, spec.name).alias("topic"),
        message_key(df.schema, spec).cast("binary").alias("key"),
        record_json(df.schema, precision=spec.precision).cast("binary").alias("value"),
        table_header(spec.name, header).alias("headers"),
        *([F.struct(*order).alias("order")] if order else []),
    )


def readable(messages: DataFrame) -> DataFrame:
    """Messages with text instead of bytes and one column per part of the only header."""
    return messages.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("headers")[0]["key"].alias("header_key"),
        F.col("headers")[0]["value"].cast("string").alias("header_value"),
    )


def colocate(df: DataFrame, key: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """All rows of a key in one partition, in order.

    A key that holds most of the rows makes one task hold them too; use
    ``contiguous`` unless the consumer needs exactly one partition per key.
    """
    spread = df.repartition(partitions, key) if partitions else df.repartition(key)
    return spread.sortWithinPartitions(key, *order)


def contiguous(df: DataFrame, key: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows of a key next to each other, in order, over as many partitions as their number needs.

    Reading the partitions in sequence gives each key's rows in order, and a hot
    key is cut into consecutive ranges instead of filling one task.
    """
    keys = [key, *order]
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys)


def limit_writers(df: DataFrame, writers: int) -> DataFrame:
    """Rows in ``writers`` tasks, the most that may write to an external system at once.

    They are shuffled there: merging partitions without a shuffle would also run
    everything before the write in that few tasks.
    """
    return df.repartition(writers)
