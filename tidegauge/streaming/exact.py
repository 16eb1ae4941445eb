"""Exact deduplication: rows are held until their time is settled, then judged in order of time.

Spark's own operator decides on arrival, so what it keeps depends on how rows fall into micro-batches
and rows of one batch are merged however far they lie apart. Here a row waits in state until the
watermark has passed it; no earlier row can come any more, so the decision never changes.

Waiting is left to Spark's aggregation by key and time. What it lets out is judged in Python, where
each access to state is a message to the JVM: a few per group of keys and batch, none per row.
"""

from __future__ import annotations

import operator
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidegauge.functions.columns import col, cols, row_digest
from tidegauge.streaming.joins import fixed_micros
from tidegauge.streaming.sources import watermarked, with_event_time

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_AT, _ROW, _NAME, _BUCKET = "_at", "_row", "_name", "_bucket"

# Groups that the keys are dealt to. A group's rows of a batch are in memory together.
BUCKETS = 1024


class FirstOfRun(StatefulProcessor):
    """Keeps a row of a name unless a kept one lies within ``distance`` microseconds before it.

    A group holds many names. Its rows are settled: a later batch has later ones only. So the state is
    the time of each name's last kept row, as long as rows that come can be within the distance.
    """

    def __init__(self, distance: int):
        self.distance = distance

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", "name string, at bigint")

    def handleInputRows(self, key, rows, timerValues):
        last = dict(self.kept.get())
        for row in sorted(rows, key=operator.itemgetter(_AT)):
            before = last.get(row[_NAME])
            if before is None or row[_AT] - before > self.distance:
                last[row[_NAME]] = row[_AT]
                yield row
        latest = self._hold(last, timerValues)
        if latest is not None:
            # Later times will have a timer of their own.
            self.handle.registerTimer(-(-(latest + self.distance) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._hold(dict(self.kept.get()), timerValues)
        return iter(())

    def _hold(self, last: dict[str, int], timer_values) -> int | None:
        """Store what is within the distance of rows to come; the latest of these times."""
        passed = timer_values.getCurrentWatermarkInMs() * 1000
        near = [(name, at) for name, at in last.items() if at + self.distance > passed]
        if near:
            self.kept.put(near)
        else:
            self.kept.clear()
        return max((at for _, at in near), default=None)


# Equal values of these types are the same value, which 0.0 and -0.0 are not.
_PLAIN = (T.IntegralType, T.DecimalType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _plain(kind: T.DataType) -> bool:
    return isinstance(kind, _PLAIN) or kind == T.StringType()


def _text(key: Column, kind: T.DataType) -> Column | None:
    """A text that tells keys of the type apart, nulls too, and can be told from what follows it."""
    if not _plain(kind):
        return None
    if isinstance(kind, T.TimestampType):
        key = F.unix_micros(key)
    text = F.hex(key) if isinstance(kind, T.BinaryType) else key.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _settled(timed: DataFrame, event_time: str, delay: str, keys: list[str]) -> DataFrame:
    """One row per key and time, the one with the smallest digest, once the watermark has passed it.

    Spark's own aggregation holds them, spread by key and time, so a busy key is not in one place.
    """
    alike = [event_time, *(k for k in keys if k != event_time)]
    rest = [f.name for f in timed.schema if f.name not in alike or not _plain(f.dataType)]
    row = F.min_by(F.struct(*cols(rest)), row_digest(timed)) if rest else F.count(F.lit(1))
    found = watermarked(timed, event_time, delay).groupBy(*cols(alike)).agg(row.alias(_ROW))
    return found.select(*(F.col(_ROW).getField(n).alias(n) if n in rest else col(n) for n in timed.columns))


def exactly_deduplicated(
    stream: DataFrame,
    event_time: str,
    delay: str,
    keys: list[str],
    within: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows that no kept row of their key precedes by ``within`` or less, in order of event time.

    ``within`` is ``delay``, the watermark's, unless given. A row appears once the watermark has passed
    it, whatever micro-batches the rows came in. Of rows with one key and one time the one with the
    smallest digest stays; null keys are a key; rows without event time are dropped. State holds what
    the watermark has not passed and one time per key for ``within`` after it. Keys are dealt to
    ``buckets`` groups, if their types have an exact text (numbers with a point and nested values have
    not and are groups of their own); a checkpoint is tied to the number.
    """
    timed = with_event_time(stream, event_time).filter(col(event_time).isNotNull())
    settled = _settled(timed, event_time, delay, keys).withColumn(_AT, F.unix_micros(col(event_time)))
    names = [_text(col(k), timed.schema[k].dataType) for k in keys]
    exact = all(name is not None for name in names)
    settled = settled.withColumns(
        {
            _NAME: F.concat(F.lit(""), *names) if exact else F.lit(""),
            _BUCKET: F.pmod(F.xxhash64(*cols(keys)), F.lit(buckets)) if exact else F.lit(0),
        }
    )
    kept = settled.groupBy(*([_BUCKET] if exact else cols(keys))).transformWithState(
        statefulProcessor=FirstOfRun(fixed_micros(within or delay)),
        outputStructType=settled.schema,
        outputMode="Append",
        timeMode="EventTime",
    )
    return kept.drop(_AT, _NAME, _BUCKET)
