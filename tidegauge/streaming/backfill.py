"""Streaming a long history without losing old rows to a watermark that has run ahead.

The file source takes files by modification time, not event time. A backfill in order first splits
the history into event-time slices and lands them oldest first, one run per slice: within a run's
single batch nothing can be late, and the next slice is newer than everything before it. Rows without
an event time belong to no slice; they are written apart and counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import as_instant, col
from tidegauge.session import scratch
from tidegauge.sources.files import SharedFiles
from tidegauge.streaming.flows import FlowRun

_SLICE, _SPREAD = "event_slice", "_spread"

# What Spark names the folder of a null partition value.
_NONE = "__HIVE_DEFAULT_PARTITION__"


class UndatedRowsError(ValueError):
    """The history holds rows without an event time and nothing says where they should go."""


def split_history(
    history: DataFrame, event_time: str, seconds: int
) -> tuple[str, list[int], str | None]:
    """Write the history by event-time slice; returns the folder, the slices, oldest first, and the
    folder of the rows without an event time, if there are any.

    Rows are ranged by slice and a row number, so a slice with a third of all rows is written by
    many tasks.
    """
    number = F.floor(F.unix_seconds(as_instant(col(event_time))) / seconds)
    folder = scratch(history.sparkSession, "history")
    (
        history.withColumn(_SLICE, number)
        .withColumn(_SPREAD, F.monotonically_increasing_id())
        .repartitionByRange(_SLICE, _SPREAD)
        .drop(_SPREAD)
        .write.partitionBy(_SLICE)
        .parquet(folder)
    )
    written = SharedFiles(history.sparkSession).children(folder)
    names = [n.split("=")[1] for n in written if n.startswith(f"{_SLICE}=")]
    undated = f"{folder}/{_SLICE}={_NONE}" if _NONE in names else None
    return folder, sorted(int(n) for n in names if n != _NONE), undated


def land_together(
    histories: list[tuple[DataFrame, str, str]],
    seconds: int,
    after_slice: Callable[[int], FlowRun],
    undated: dict[str, str] | None = None,
) -> list[FlowRun]:
    """Append several histories to their landings slice by slice, running a flow after each slice.

    ``histories`` are tables, their event-time columns and landings. All are landed up to the same
    time before a run, so a flow that joins them never has a watermark that one of them has still to
    reach, whichever of the streams decides it. Rows without an event time go to the place that
    ``undated`` has for a landing; without one they are an error, raised before anything lands.
    """
    split = [(df, landing, *split_history(df, time, seconds)) for df, time, landing in histories]
    for df, landing, _, _, without_time in split:
        if without_time is not None and landing not in (undated or {}):
            raise UndatedRowsError(f"rows without event time for {landing}: name a place for them")
    for df, landing, _, _, without_time in split:
        # A stream whose history begins later must find its folder.
        df.limit(0).write.mode("append").parquet(landing)
        if without_time is not None:
            rows = df.sparkSession.read.schema(df.schema).parquet(without_time)
            rows.write.mode("append").parquet(undated[landing])
    runs = []
    for number in sorted({n for _, _, _, slices, _ in split for n in slices}):
        for df, landing, folder, slices, _ in split:
            if number in slices:
                part = f"{folder}/{_SLICE}={number}"
                df.sparkSession.read.schema(df.schema).parquet(part).write.mode("append").parquet(landing)
                SharedFiles(df.sparkSession).delete(part)
        runs.append(after_slice(number))
    return runs


def land_in_order(
    history: DataFrame,
    event_time: str,
    seconds: int,
    landing: str,
    after_slice: Callable[[int], FlowRun] | None = None,
    undated: str | None = None,
) -> list[FlowRun]:
    """Append the history to ``landing`` oldest slice first, running a flow after each slice.

    Rows without an event time are appended to ``undated``; without that path their presence is an
    error, raised before anything lands. A slice's copy goes once it has landed.
    """
    spark = history.sparkSession
    files = SharedFiles(spark)
    folder, slices, without_time = split_history(history, event_time, seconds)
    reader = spark.read.schema(history.schema)
    if without_time is not None:
        if undated is None:
            raise UndatedRowsError(f"rows without {event_time}: name a place for them")
        reader.parquet(without_time).write.mode("append").parquet(undated)
    runs = []
    for number in slices:
        part = f"{folder}/{_SLICE}={number}"
        reader.parquet(part).write.mode("append").parquet(landing)
        files.delete(part)
        if after_slice is not None:
            runs.append(after_slice(number))
    return runs
