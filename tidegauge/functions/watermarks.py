"""Typed high-watermark expressions: predicates, lookback, epoch conversion and order keys.

A watermark is kept as text with a type tag: ``timestamp``, ``epoch_ms``, ``date`` or ``bigint``.
Predicates are built as columns over a folded literal, so they reach Parquet and JDBC scans; the
text form is only for hand-written JDBC subqueries.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import col

WATERMARK_TYPES = ("timestamp", "epoch_ms", "date", "bigint")
DEFAULT_LOOKBACK_MINUTES = 30
_MINUTES_PER_DAY = 24 * 60


def check_type(kind: str) -> str:
    if kind not in WATERMARK_TYPES:
        raise ValueError(f"watermark type must be one of {WATERMARK_TYPES}, not {kind!r}")
    return kind


def typed_value(text: str, kind: str) -> int | date | datetime:
    """The watermark text as a Python value that orders the way its type orders."""
    if check_type(kind) in ("epoch_ms", "bigint"):
        return int(text)
    if kind == "date":
        return date.fromisoformat(text[:10])
    return datetime.fromisoformat(text)


def later(old: str | None, new: str | None, kind: str) -> str | None:
    """The greater of two watermarks, compared by type; null never replaces a value."""
    if old is None or new is None:
        return new if old is None else old
    return max(old, new, key=lambda text: typed_value(text, kind))


def watermark_text(df: DataFrame, column: str) -> Column:
    """A watermark column as text; instants in UTC with a zone mark, so session zones may change."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        utc = F.to_utc_timestamp(col(column), F.current_timezone())
        return F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'")
    return col(column).cast("string")


def since(df: DataFrame, column: str, kind: str, value: str, lookback_minutes: int = 0) -> Column:
    """``column > value - lookback`` in the column's own type.

    For dates the lookback is rounded up to whole days, as rows of the watermark's own day may still
    come; it does not apply to ``bigint``.
    """
    bound: Column
    if check_type(kind) == "epoch_ms":
        bound = F.lit(int(value) - lookback_minutes * 60_000)
    elif kind == "bigint":
        bound = F.lit(int(value))
    elif kind == "date":
        earlier = typed_value(value, kind) - timedelta(days=_whole_days(lookback_minutes))
        bound = F.lit(earlier.isoformat())
    else:
        bound = F.lit(str(typed_value(value, kind) - timedelta(minutes=lookback_minutes)))
    return col(column) > bound.cast(df.schema[column].dataType)


def _whole_days(minutes: int) -> int:
    return -(-minutes // _MINUTES_PER_DAY)


def jdbc_predicate(column: str, kind: str, value: str, lookback_minutes: int = 0) -> str:
    """The same bound as SQL text for a JDBC subquery."""
    known = typed_value(value, kind)
    if kind == "bigint":
        return f"{column} > {known}"
    if kind == "epoch_ms":
        return f"{column} > {known - lookback_minutes * 60_000}"
    if kind == "date":
        earlier = known - timedelta(days=_whole_days(lookback_minutes))
        return f"{column} > DATE '{earlier.isoformat()}'"
    moment = (known - timedelta(minutes=lookback_minutes)).replace(tzinfo=None)
    return f"{column} > TIMESTAMP '{moment.isoformat(sep=' ')}'"


def epoch_ms_to_timestamp(value: Column) -> Column:
    return F.timestamp_millis(value)


def timestamp_to_epoch_ms(value: Column) -> Column:
    return F.unix_millis(value.cast("timestamp"))


def order_key(moment: Column, sequence: Column, digits: int = 12) -> Column:
    """One increasing number for (time, sequence): microseconds, then the padded sequence.

    Sequences run from 0 to 10**digits - 1; others give null, or an error in ANSI mode.
    """
    micros = F.unix_micros(moment.cast("timestamp")).cast("decimal(20,0)")
    padded = micros * F.lit(10**digits).cast(f"decimal({digits + 1},0)")
    return (padded + sequence.cast(f"decimal({digits},0)")).cast("decimal(38,0)")
