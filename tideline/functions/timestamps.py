"""Strict timestamp parsing and the precision at which progress is compared."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.specs import WIRE_TS_PATTERN


def strict_ts(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as TIMESTAMP_NTZ; NULL for any other text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(WIRE_TS_PATTERN), text.try_cast("timestamp_ntz"))


def is_bad_ts(text: Column | str) -> Column:
    """True where a value is present but is not a timestamp."""
    text = F.col(text) if isinstance(text, str) else text
    return text.isNotNull() & strict_ts(text).isNull()


def utc_clock(name: str) -> Column:
    """The UTC wall clock of a TIMESTAMP, whatever the time zone of the session."""
    since = F.make_dt_interval(secs=F.unix_micros(name).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def position_ts(name: str, dtype: T.DataType, precision: str) -> Column:
    """The timestamp of a row as progress sees it; NULL where it cannot be read."""
    if isinstance(dtype, T.TimestampType):
        ts = utc_clock(name)
    else:
        ts = strict_ts(name) if isinstance(dtype, T.StringType) else F.col(name).cast("timestamp_ntz")
    return whole_second(ts) if precision == "second" else ts


def whole_second(ts: Column) -> Column:
    """A TIMESTAMP_NTZ without its fraction, in no time zone."""
    second = F.date_part(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(secs=second - F.floor(second))


def naive_utc(value: datetime) -> datetime:
    """The UTC wall clock of ``value``; a naive value already is one."""
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
