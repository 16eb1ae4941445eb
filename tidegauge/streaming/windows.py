"""Windowed counts over event time; results come out once the watermark has closed a window.

Counts are combined before the shuffle, so a key with a third of the events costs one row per task
and window. The window is always built on the watermark column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import col, cols, quoted
from tidegauge.streaming.sources import watermarked, with_event_time


def _flat(counted: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return counted.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *cols(keys),
        *names,
    )


def _aggregated(df: DataFrame, window: Column, keys: list[str], measures: dict[str, Column] | None):
    measures = measures or {"n": F.count(F.lit(1))}
    grouped = df.groupBy(window.alias("_window"), *cols(keys))
    counted = grouped.agg(*[m.alias(name) for name, m in measures.items()])
    return _flat(counted, keys, list(measures))


def windowed_counts(
    stream: DataFrame,
    event_time: str,
    delay: str,
    size: str,
    keys: list[str],
    slide: str | None = None,
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``; counts unless other measures are given."""
    timed = watermarked(stream, event_time, delay)
    return _aggregated(timed, F.window(col(event_time), size, slide), keys, measures)


def session_counts(
    stream: DataFrame,
    event_time: str,
    delay: str,
    gap: str,
    keys: list[str],
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Sessions per key that end after ``gap`` without events."""
    timed = watermarked(stream, event_time, delay)
    return _aggregated(timed, F.session_window(col(event_time), gap), keys, measures)


def windowed_counts_sql(
    stream: DataFrame, event_time: str, delay: str, size: str, keys: list[str]
) -> DataFrame:
    """The tumbling count through SQL's WATERMARK clause."""
    view = f"stream_{uuid.uuid4().hex}"
    with_event_time(stream, event_time).createOrReplaceTempView(view)
    time, names = quoted(event_time), [quoted(k) for k in keys]
    listed = ", ".join([f"window({time}, '{size}') AS _window", *names, "count(*) AS n"])
    try:
        counted = stream.sparkSession.sql(
            f"SELECT {listed} FROM {view} WATERMARK {time} DELAY OF INTERVAL {delay} "
            f"GROUP BY {', '.join(['_window', *names])}"
        )
    finally:
        # The plan holds the stream by now.
        stream.sparkSession.catalog.dropTempView(view)
    return _flat(counted, keys, ["n"])
