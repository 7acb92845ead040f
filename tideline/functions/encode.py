"""Record values, topic names and headers of outgoing messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.specs import WIRE_TS_FORMAT


def record_json(schema: T.StructType, fields: Sequence[str] = (), precision: str = "micros") -> Column:
    """The record as one JSON object with sorted field names and explicit nulls."""
    ts_format = WIRE_TS_FORMAT + (".SSSSSS" if precision == "micros" else "")
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": ts_format,
        "timestampNTZFormat": ts_format,
    }
    return F.to_json(F.struct(*[F.col(name) for name in sorted(fields or schema.names)]), options)


def flat_strings(fields: Sequence[str]) -> list[Column]:
    """Every field as optional text, the value schema of the binary encoding."""
    if not fields:
        raise ValueError("a flat text record needs at least one field")
    return [F.col(name).cast("string").alias(name) for name in fields]


def flat_schema(fields: Sequence[str]) -> T.StructType:
    if not fields:
        raise ValueError("a flat text record needs at least one field")
    return T.StructType([T.StructField(name, T.StringType(), True) for name in fields])


def topic_name(topic: Column | str, prefix: Column | str, table: Column | str) -> Column:
    """The explicit topic, else ``prefix.table``; text arguments are constants."""
    topic, prefix, table = (F.lit(v) if isinstance(v, str) else v for v in (topic, prefix, table))
    return F.coalesce(F.nullif(topic, F.lit("")), F.concat_ws(".", prefix, table))


def table_header(table: str, header: str) -> Column:
    """One header that names the source table."""
    return F.array(F.struct(F.lit(header).alias("key"), F.encode(F.lit(table), "UTF-8").alias("value")))
