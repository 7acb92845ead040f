"""Filter vocabulary over named columns, composed into clauses.

A predicate is a function of the schema, so that literals take the type of the
column they are compared with.  The column side is never cast or wrapped, which
keeps every comparison eligible for pushdown to the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timestamps import naive_utc

Predicate = Callable[[T.StructType], Column]


def literal(value: Any, dtype: T.DataType) -> Column:
    """``value`` as a constant of the column type ``dtype``."""
    if isinstance(value, datetime):
        value = naive_utc(value)
        if isinstance(dtype, T.StringType):
            return F.lit(value.strftime("%Y-%m-%d %H:%M:%S"))
        text = value.isoformat(sep=" ", timespec="microseconds")
        return F.lit(text + ("Z" if isinstance(dtype, T.TimestampType) else "")).cast(dtype)
    return F.lit(value).cast(dtype)


def _compare(field: str, value: Any, op: Callable[[Column, Column], Column]) -> Predicate:
    return lambda schema: op(F.col(field), literal(value, schema[field].dataType))


def eq(field: str, value: Any) -> Predicate:
    return _compare(field, value, lambda c, v: c == v)


def ne(field: str, value: Any) -> Predicate:
    return _compare(field, value, lambda c, v: c != v)


def gt(field: str, value: Any) -> Predicate:
    return _compare(field, value, lambda c, v: c > v)


def ge(field: str, value: Any) -> Predicate:
    return _compare(field, value, lambda c, v: c >= v)


def lt(field: str, value: Any) -> Predicate:
    return _compare(field, value, lambda c, v: c < v)


def le(field: str, value: Any) -> Predicate:
    return _compare(field, value, lambda c, v: c <= v)


def is_anything(field: str) -> Predicate:
    """Every row, also where the field is NULL."""

    def build(schema: T.StructType) -> Column:
        schema[field]
        return F.lit(True)

    return build


def _is_text(schema: T.StructType, field: str) -> bool:
    return isinstance(schema[field].dataType, (T.StringType, T.CharType, T.VarcharType))


def is_empty_string(field: str) -> Predicate:
    return lambda schema: F.col(field) == "" if _is_text(schema, field) else F.lit(False)


def is_empty(field: str) -> Predicate:
    return lambda schema: (
        F.col(field).isNull() | (F.col(field) == "") if _is_text(schema, field) else F.col(field).isNull()
    )


def is_not_empty(field: str) -> Predicate:
    return lambda schema: (
        F.col(field).isNotNull() & (F.col(field) != "") if _is_text(schema, field) else F.col(field).isNotNull()
    )


def starts_with(field: str, prefix: str) -> Predicate:
    return lambda schema: F.col(field).startswith(prefix)


def like(field: str, part: str) -> Predicate:
    """The text contains ``part``; no character is a wildcard."""
    return lambda schema: F.col(field).contains(part)


def not_like(field: str, part: str) -> Predicate:
    return lambda schema: ~F.col(field).contains(part)


def ts_eq(field: str, value: datetime, precision: str = "second") -> Predicate:
    """Equal timestamps; at second precision any fraction of that second matches.

    The second is written as a range instead of a truncation of the column, so
    that min/max statistics still prune.
    """
    if precision == "micros":
        return eq(field, value)
    start = naive_utc(value).replace(microsecond=0)

    def build(schema: T.StructType) -> Column:
        dtype = schema[field].dataType
        if isinstance(dtype, T.StringType):
            return F.col(field) == literal(start, dtype)
        upper = literal(start + timedelta(seconds=1), dtype)
        return (F.col(field) >= literal(start, dtype)) & (F.col(field) < upper)

    return build


def between_inclusive(field: str, first: Any, through: Any) -> Predicate:
    return lambda schema: ge(field, first)(schema) & le(field, through)(schema)


def between_exclusive(field: str, first: Any, through: Any) -> Predicate:
    return lambda schema: gt(field, first)(schema) & lt(field, through)(schema)


class Clause:
    """All terms must hold; a term is one predicate or alternatives added by ``or_*``."""

    def __init__(self, terms: tuple[tuple[Predicate, ...], ...] = ()):
        self._terms = terms

    def where(self, predicate: Predicate) -> Clause:
        return Clause((*self._terms, (predicate,)))

    def or_where(self, predicate: Predicate) -> Clause:
        """An alternative to the predicate added just before."""
        if not self._terms:
            raise ValueError("an or_* predicate needs a predicate before it")
        return Clause((*self._terms[:-1], (*self._terms[-1], predicate)))

    def eq(self, field: str, value: Any) -> Clause:
        return self.where(eq(field, value))

    def or_eq(self, field: str, value: Any) -> Clause:
        return self.or_where(eq(field, value))

    def ne(self, field: str, value: Any) -> Clause:
        return self.where(ne(field, value))

    def or_ne(self, field: str, value: Any) -> Clause:
        return self.or_where(ne(field, value))

    def gt(self, field: str, value: Any) -> Clause:
        return self.where(gt(field, value))

    def ge(self, field: str, value: Any) -> Clause:
        return self.where(ge(field, value))

    def lt(self, field: str, value: Any) -> Clause:
        return self.where(lt(field, value))

    def le(self, field: str, value: Any) -> Clause:
        return self.where(le(field, value))

    def is_anything(self, field: str) -> Clause:
        return self.where(is_anything(field))

    def is_empty_string(self, field: str) -> Clause:
        return self.where(is_empty_string(field))

    def is_empty(self, field: str) -> Clause:
        return self.where(is_empty(field))

    def is_not_empty(self, field: str) -> Clause:
        return self.where(is_not_empty(field))

    def starts_with(self, field: str, prefix: str) -> Clause:
        return self.where(starts_with(field, prefix))

    def like(self, field: str, part: str) -> Clause:
        return self.where(like(field, part))

    def not_like(self, field: str, part: str) -> Clause:
        return self.where(not_like(field, part))

    def ts_eq(self, field: str, value: datetime, precision: str = "second") -> Clause:
        return self.where(ts_eq(field, value, precision))

    def between_inclusive(self, field: str, first: Any, through: Any) -> Clause:
        return self.where(between_inclusive(field, first, through))

    def between_exclusive(self, field: str, first: Any, through: Any) -> Clause:
        return self.where(between_exclusive(field, first, through))

    def union(self, other: Clause | ClauseUnion) -> ClauseUnion:
        """Rows that match either side, read by one scan and returned once."""
        return ClauseUnion((self,)).union(other)

    def on(self, source: DataFrame | T.StructType) -> Column:
        schema = source.schema if isinstance(source, DataFrame) else source
        terms = [reduce(or_, [p(schema) for p in term]) for term in self._terms]
        return reduce(and_, terms) if terms else F.lit(True)


class ClauseUnion:
    """Any of several clauses."""

    def __init__(self, clauses: tuple[Clause, ...]):
        self._clauses = clauses

    def union(self, other: Clause | ClauseUnion) -> ClauseUnion:
        more = other._clauses if isinstance(other, ClauseUnion) else (other,)
        return ClauseUnion(self._clauses + more)

    def on(self, source: DataFrame | T.StructType) -> Column:
        return reduce(or_, [clause.on(source) for clause in self._clauses])
