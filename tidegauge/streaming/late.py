"""Rows put aside when they come, late or unreadable, and what is still open in state."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import as_instant, col
from tidegauge.operators.changes import without_keys_of
from tidegauge.operators.parsing import is_rejected, parsed
from tidegauge.sources.files import SharedFiles
from tidegauge.streaming.flows import FlowRun, run_flow
from tidegauge.streaming.joins import BUCKET, SALT
from tidegauge.streaming.sources import watermarked

LATE, REJECTED, BATCH = "late", "rejected", "batch"


def batch_watermark(files: SharedFiles, checkpoint: str, number: int) -> int:
    """The watermark in milliseconds that a micro-batch started with, from the checkpoint."""
    lines = files.read_text(f"{checkpoint}/offsets/{number}").split("\n")
    return json.loads(lines[1])["batchWatermarkMs"]


def split_flow(
    stream: DataFrame,
    checkpoint: str,
    path: str,
    name: str,
    flag: str,
    marked: Callable[[DataFrame, int], DataFrame],
) -> FlowRun:
    """Write every micro-batch in one pass to two tables below ``path``, by a boolean column.

    ``marked`` adds the column. A batch's folders are replaced when the engine repeats the batch, so
    no row is written twice.
    """

    def each(batch: DataFrame, number: int) -> None:
        rows = marked(batch, number)
        rows.write.mode("overwrite").partitionBy(flag).parquet(f"{path}/{BATCH}={number}")

    return run_flow(stream, checkpoint, name, each_batch=each)


def split_late(
    stream: DataFrame, event_time: str, delay: str, checkpoint: str, path: str, name: str = "late"
) -> FlowRun:
    """Rows in time and late rows in two tables below ``path``.

    A row is late that the batch's watermark has reached, which is what stateful operators drop.
    Rows without event time are in time: no watermark says otherwise.
    """
    files = SharedFiles(stream.sparkSession)

    def marked(batch: DataFrame, number: int) -> DataFrame:
        reached = batch_watermark(files, checkpoint, number)
        at = F.unix_millis(as_instant(col(event_time)))
        # A watermark of 0 is one that has seen no row.
        is_late = F.coalesce(at <= reached, F.lit(False)) if reached > 0 else F.lit(False)
        return batch.withColumn(LATE, is_late)

    return split_flow(watermarked(stream, event_time, delay), checkpoint, path, name, LATE, marked)


def split_rejects(
    stream: DataFrame, checkpoint: str, path: str, name: str = "rejects", **parsing
) -> FlowRun:
    """Rows that could be parsed and a quarantine of the others; see ``operators.parsing.parsed``."""

    def marked(batch: DataFrame, number: int) -> DataFrame:
        return parsed(batch, **parsing).withColumn(REJECTED, is_rejected())

    return split_flow(stream, checkpoint, path, name, REJECTED, marked)


def split_rows(spark: SparkSession, path: str, flag: str, value: bool | None = None) -> DataFrame:
    """What a splitting flow wrote, with ``batch`` and the flag; all rows, or those of one value."""
    rows = spark.read.option("basePath", path).parquet(path)
    rows = rows.withColumn(flag, F.col(flag).cast("boolean"))
    return rows if value is None else rows.filter(F.col(flag) == value)


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a windowed aggregate holds in state after its last batch: windows that are not closed.

    One row per window and group: ``window_start``, ``window_end``, the group columns and the partial
    aggregates as the state stores them, numbered ``state_0`` and on.
    """
    state = _state(spark, checkpoint, operator)
    key, value = state.schema["key"].dataType, state.schema["value"].dataType
    window = next(f.name for f in key if f.name == "window" or "window" in f.name)
    groups = [F.col("key")[f.name].alias(f.name) for f in key if f.name != window]
    # Group columns are stored again in front of the buffers.
    buffers = value.names[len(value) - _buffers(key, value) :]
    return state.select(
        F.col("key")[window]["start"].alias("window_start"),
        F.col("key")[window]["end"].alias("window_end"),
        *groups,
        *[F.col("value")[b].alias(f"state_{i}") for i, b in enumerate(buffers)],
    )


def _buffers(key, value) -> int:
    return len([n for n in value.names if n not in key.names])


def pending_rows(
    spark: SparkSession,
    checkpoint: str,
    side: str = "left",
    emitted: DataFrame | None = None,
    keys: list[str] | None = None,
    operator: int = 0,
) -> DataFrame:
    """The rows of one side that a stream-stream join still holds after its last batch.

    State also keeps rows that have matched, as more matches may come; with ``emitted``, what the
    join has put out, and the ``keys`` of a row, those are left out: what stays is waiting for its
    first match, or for the null row of an outer join.
    """
    held = _state(spark, checkpoint, operator, joinSide=side).select("value.*")
    held = held.drop(*(c for c in held.columns if c in (BUCKET, SALT))).distinct()
    return held if emitted is None else without_keys_of(held, emitted, keys or [])


def _state(spark: SparkSession, checkpoint: str, operator: int, **options: str) -> DataFrame:
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    return reader.options(**options).load()
