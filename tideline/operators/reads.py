"""Reading a table: filter, order, offset, limit and field list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.predicates import Clause, ClauseUnion
from tideline.specs import TableSpec


def ordering(order: Sequence[tuple[str, str]]) -> list[Column]:
    """Sort columns from ``(field, "asc" | "desc")`` pairs, most significant first."""
    unknown = [direction for _, direction in order if direction not in ("asc", "desc")]
    if unknown:
        raise ValueError(f"a sort direction is 'asc' or 'desc', got {unknown[0]!r}")
    return [F.col(field).asc() if direction == "asc" else F.col(field).desc() for field, direction in order]


def positions(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with ``row_no``, its place in ``order`` from 1; the order should be total."""
    from tideline.operators.numbering import number_rows  # which itself reads tables by this module

    ordering(order)
    return number_rows(df, [F.col(field) for field, _ in order], descending=[way == "desc" for _, way in order])


def read_records(
    df: DataFrame,
    clause: Clause | ClauseUnion | None = None,
    *,
    order: Sequence[tuple[str, str]] = (),
    offset: int = -1,
    limit: int = 0,
    fields: Sequence[str] = (),
) -> DataFrame:
    """Rows that match ``clause``, in ``order``.

    ``offset`` counts when it is 0 or more and ``limit`` when it is above 0; an
    empty field list keeps every column.
    """
    if clause is not None:
        df = df.where(clause.on(df))
    if order and offset > 0 and limit <= 0:
        placed = positions(df, order)
        df = placed.where(F.col("row_no") > offset).drop("row_no")
        offset = 0
    if order:
        df = df.orderBy(*ordering(order))
    if offset > 0:
        df = df.offset(offset)
    if limit > 0:
        df = df.limit(limit)
    return df.select(*fields) if fields else df


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's fields, always with the two columns that make up its position."""
    if not spec.fields:
        return df
    kept = list(spec.fields) + [c for c in (spec.ts_col, spec.id_col) if c not in spec.fields]
    return df.select(*kept)


def strip_links(df: DataFrame) -> DataFrame:
    """Reference fields, landed as ``{link, value}``, become their plain value."""
    return df.select(
        *[
            F.col(f.name)["value"].alias(f.name)
            if isinstance(f.dataType, T.StructType) and set(f.dataType.names) == {"link", "value"}
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
