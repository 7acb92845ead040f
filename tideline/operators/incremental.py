"""Incremental extraction by (timestamp, identifier) position.

A pull reads the rows after the stored position and before ``now - delay``.  With
a limit it is one step of a drain; without one it is the whole backlog in a single
scan that neither sorts nor shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.predicates import Clause, eq, ge, gt, is_not_empty, le, literal, lt, ts_eq
from tideline.functions.timestamps import naive_utc, position_ts, strict_ts
from tideline.operators.reads import project
from tideline.specs import Progress, TableSpec

EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Bounds:
    """The window of one pull: ``first`` inclusive after ``last_id``, ``through`` exclusive."""

    first: datetime | None
    last_id: str
    through: datetime


def bounds(progress: Progress | None, now: datetime, delay_seconds: int = 0, initial_hours: int = -1) -> Bounds:
    """Stored progress, else ``initial_hours`` before now, else no lower bound."""
    now = naive_utc(now)
    through = now - timedelta(seconds=delay_seconds)
    if progress is not None and not progress.is_zero:
        return Bounds(naive_utc(progress.ts) if progress.ts else EPOCH, progress.last_identifier, through)
    if initial_hours < 0:
        return Bounds(None, "", through)
    return Bounds(now - timedelta(hours=initial_hours), "", through)


def due(schema: T.StructType, spec: TableSpec, window: Bounds) -> Column:
    """The filter of one pull.

    At second precision both sides are compared by whole seconds, expressed as
    ranges on the bare column.  The lower bound is repeated outside the OR, as
    only a plain conjunct prunes files and partitions.
    """
    ts, ident = spec.ts_col, spec.id_col
    through, first = window.through, window.first
    if spec.precision == "second":
        through = through.replace(microsecond=0)
    present = Clause().where(is_not_empty(ident))
    if first is None:
        return present.where(lt(ts, through)).on(schema)

    if spec.precision == "second":
        first = first.replace(microsecond=0)
    if spec.precision == "second" and not isinstance(schema[ts].dataType, T.StringType):
        same = ts_eq(ts, first, "second")
        later = ge(ts, first + timedelta(seconds=1))
    else:
        same, later = eq(ts, first), gt(ts, first)
    tied = Clause().where(same)
    if window.last_id:
        tied = tied.where(gt(ident, window.last_id))
    newer = Clause().where(later).where(lt(ts, through))

    floor = present.where(ge(ts, first))
    if spec.partition_col:
        floor = floor.where(ge(spec.partition_col, first.replace(hour=0, minute=0, second=0, microsecond=0)))
    return floor.on(schema) & tied.union(newer).on(schema)


def processing_order(schema: T.StructType, spec: TableSpec) -> list[Column]:
    """Timestamp at the table's precision, then identifier."""
    dtype = schema[spec.ts_col].dataType
    if spec.precision == "second" and not isinstance(dtype, T.StringType):
        return [position_ts(spec.ts_col, dtype, "second"), F.col(spec.id_col)]
    return [F.col(spec.ts_col), F.col(spec.id_col)]


def pull(
    df: DataFrame,
    spec: TableSpec,
    progress: Progress | None = None,
    *,
    now: datetime,
    delay_seconds: int = 0,
    initial_hours: int = -1,
    limit: int | None = None,
) -> DataFrame:
    """Rows due after ``progress``; the first ``limit`` of them in processing order if given."""
    rows = df.where(due(df.schema, spec, bounds(progress, now, delay_seconds, initial_hours)))
    if limit:
        rows = rows.orderBy(*processing_order(df.schema, spec)).limit(limit)
    return project(rows, spec)


def progress_columns(schema: T.StructType, spec: TableSpec, mode: str = "atomic", pos: Column | None = None):
    """Aggregates for the timestamp and the identifier of the last processed row.

    ``atomic`` takes both from one row that has both.  ``independent`` takes the
    last readable timestamp and the last present identifier, which may come from
    different rows.
    """
    ts = position_ts(spec.ts_col, schema[spec.ts_col].dataType, spec.precision)
    ident = F.col(spec.id_col)
    if mode == "atomic":
        order = F.struct(ts.alias("ts"), ident.alias("id")) if pos is None else pos
        last = F.max_by(
            F.struct(ts.alias("ts"), ident.cast("string").alias("id")),
            F.when(ts.isNotNull() & ident.isNotNull(), order),
        )
        return last["ts"], last["id"]
    if mode == "independent":
        order = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(processing_order(schema, spec))])
        order = order if pos is None else pos
        return (
            F.max_by(ts, F.when(ts.isNotNull(), order)),
            F.max_by(ident.cast("string"), F.when(ident.isNotNull(), order)),
        )
    raise ValueError(f"mode is 'atomic' or 'independent', got {mode!r}")


def advance(
    df: DataFrame,
    spec: TableSpec,
    previous: Progress | None = None,
    *,
    mode: str = "atomic",
    pos: Column | None = None,
) -> DataFrame:
    """One row ``(table, ts, last_identifier)``: the position after processing ``df``.

    Parts that no row provides stay as they were.  ``pos`` is the processing
    order where it is not that of the table.
    """
    previous = previous or Progress()
    ts, ident = progress_columns(df.schema, spec, mode, pos)
    old_ts = literal(previous.ts, T.TimestampNTZType())
    return df.agg(ts.alias("_ts"), ident.alias("_id")).select(
        F.lit(spec.name).alias("table"),
        F.coalesce("_ts", old_ts).alias("ts"),
        F.coalesce("_id", F.lit(previous.last_identifier)).alias("last_identifier"),
    )


def lag_seconds(df: DataFrame, by: str, ts_col: str, now: datetime) -> DataFrame:
    """Whole seconds between ``now`` and the newest timestamp of each ``by`` value."""
    is_text = isinstance(df.schema[ts_col].dataType, T.StringType)
    newest = F.max(strict_ts(ts_col) if is_text else F.col(ts_col))
    at = F.unix_timestamp(literal(now, T.TimestampNTZType()))
    return df.groupBy(by).agg((at - F.unix_timestamp(newest)).alias("lag_seconds"))


def late_rows(
    df: DataFrame, spec: TableSpec, progress: Progress, published: DataFrame, since: datetime | None = None
) -> DataFrame:
    """Rows at or before ``progress`` that were never published.

    They arrived later than the delay allowed for, so no further pull returns
    them.  ``published`` needs the identifier and timestamp columns.  ``since``
    leaves out rows from before it, so that a regular audit need not read the
    whole history again.
    """
    ts, ident = spec.ts_col, spec.id_col
    schema = df.schema
    before = Clause().where(lt(ts, progress.ts))
    after = progress.ts + timedelta(seconds=1)
    by_second = spec.precision == "second"
    tied = Clause().where(ge(ts, progress.ts)).where(lt(ts, after)) if by_second else Clause().where(eq(ts, progress.ts))
    tied = tied.where(le(ident, progress.last_identifier))
    passed = df.where(Clause().where(is_not_empty(ident)).on(schema) & before.union(tied).on(schema))
    sent = published.where((lt(ts, after) if by_second else le(ts, progress.ts))(published.schema)).select(ident, ts)
    if since is not None:
        passed, sent = (side.where(ge(ts, since)(side.schema)) for side in (passed, sent))
    return passed.join(sent, [ident, ts], "left_anti")
