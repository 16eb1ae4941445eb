"""Stream-stream joins within a time bound, and streams beside a static table.

Matches lie within ``within`` after the left event, so both sides are also joined on a time bucket
of that length: a left row has one bucket, a right row is put in its own and the one before. Every
pair still meets exactly once, and the state of a busy key is spread over its buckets instead of
sitting in one partition. A key that is busy within one bucket can be salted as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import col, row_digest
from tidegauge.streaming.sources import watermarked

BUCKET, SALT = "_bucket", "_salt"


class UnboundedStateError(ValueError):
    """A stream-stream join without watermarks and a time bound would keep state for ever."""


def require_bounds(left_delay: str | None, right_delay: str | None, within: str | None) -> None:
    """Spark itself refuses only outer joins; an unbounded inner join would run and grow."""
    missing = [
        name
        for name, given in (("left", left_delay), ("right", right_delay))
        if not given
    ]
    if missing:
        raise UnboundedStateError(f"no watermark on the {' and '.join(missing)} stream")
    if not within:
        raise UnboundedStateError("no time bound between the streams")


_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_PART = re.compile(r"\s*(\d+)\s+([a-z]+?)s?(?=\s|$)", re.IGNORECASE)

# Calendar days can be this much shorter than 24 hours where clocks change.
_CLOCK_CHANGE = 3 * _MICROS["hour"]


def fixed_micros(within: str) -> int:
    """Microseconds of a bound such as ``3 MINUTES`` or ``1 day 2 hours``.

    Units have a fixed length; months and years have not and are refused.
    """
    total, at = 0, 0
    for part in _PART.finditer(within):
        unit = part.group(2).lower()
        if part.start() != at or unit not in _MICROS:
            break
        total, at = total + int(part.group(1)) * _MICROS[unit], part.end()
    if at == 0 or within[at:].strip():
        raise ValueError(f"a time bound in fixed units is needed, not {within!r}")
    return total


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    within: str,
    left_delay: str | None,
    right_delay: str | None,
    how: str = "leftOuter",
    salts: int = 1,
) -> DataFrame:
    """Left rows with the right rows of equal key from ``left_time`` to ``left_time + within``.

    The bound counts elapsed time in fixed units, days as 24 hours, whatever the session's zone does
    in between; ``0 SECONDS`` asks for equal times. With ``leftOuter`` an unmatched left row
    appears, with nulls, once the watermark shows that no match can come (for bounds of a day or
    more three hours later, as Spark's own bound follows the calendar). Columns of the right side
    keep their names, its keys become ``right_<key>``; the other names of both sides must differ.
    Works on batch DataFrames too.

    With ``salts`` the left rows of a key that is hot even within one bucket are spread over that
    many parts, and right rows are copied to each; a stream's checkpoint is tied to the number.
    """
    require_bounds(left_delay, right_delay, within)
    if how not in ("inner", "leftOuter"):
        raise ValueError("how must be inner or leftOuter")
    micros = fixed_micros(within)
    step = max(micros, _MICROS["second"])
    left, right = watermarked(left, left_time, left_delay), watermarked(right, right_time, right_delay)

    salt = F.pmod(row_digest(left), F.lit(salts)).cast("int")
    left = left.withColumns({BUCKET: _bucket_of(col(left_time), step), SALT: salt})
    own = _bucket_of(col(right_time), step)
    right = right.withColumn("_right_bucket", F.explode(F.array(own, own - 1)))
    right = right.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    for key in keys:
        right = right.withColumnRenamed(key, f"right_{key}")

    match = (F.col(BUCKET) == F.col("_right_bucket")) & (F.col(SALT) == F.col("_right_salt"))
    for key in keys:
        match = match & (col(key) == col(f"right_{key}"))
    # The first two bounds are what Spark reads to let state go, the last one is exact.
    slack = _CLOCK_CHANGE if micros >= _MICROS["day"] else 0
    whole, rest = divmod(micros + slack, 1_000_000)
    bound = F.expr(f"INTERVAL '{whole}.{rest:06d}' SECOND")
    match = match & (col(right_time) >= col(left_time)) & (col(right_time) <= col(left_time) + bound)
    if slack:
        match = match & (F.unix_micros(col(right_time)) - F.unix_micros(col(left_time)) <= micros)
    return left.join(right, match, how).drop(BUCKET, "_right_bucket", SALT, "_right_salt")


def _bucket_of(time: Column, step: int) -> Column:
    """The number of whole steps since the epoch, rounded down before it too."""
    micros, size = F.unix_micros(time), F.lit(step)
    return F.call_function("div", micros - F.pmod(micros, size), size)
