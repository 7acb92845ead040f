"""Message keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.specs import TableSpec


def identifier_key(schema: T.StructType, id_col: str) -> Column:
    """The identifier as text; NULL where it is missing."""
    return F.col(id_col).cast("string") if id_col in schema.names else no_key()


def no_key() -> Column:
    """A NULL key: the log spreads such messages evenly."""
    return F.lit(None).cast("string")


def composite_key(schema: T.StructType, fields: Sequence[str]) -> Column:
    """SHA-256 of the field values, in field-name order, as 64 hex characters.

    A missing value counts as empty text and keeps its place, so ``("a", NULL)``
    and ``(NULL, "a")`` have different keys.
    """
    if not fields:
        return no_key()
    parts = [
        F.coalesce(F.col(name).cast("string"), F.lit("")) if name in schema.names else F.lit("")
        for name in sorted(fields)
    ]
    return F.sha2(F.concat_ws("\0", *parts), 256)


def message_key(schema: T.StructType, spec: TableSpec) -> Column:
    """The key the table's mode asks for, as text."""
    if spec.key_mode == "round_robin":
        return no_key()
    if spec.key_mode == "field_based":
        return composite_key(schema, spec.key_fields)
    return identifier_key(schema, spec.id_col)
