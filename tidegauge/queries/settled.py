"""Streaming queries on rows that wait: exact deduplication, open state, late and unreadable rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.queries.base import Registry, table, table_path
from tidegauge.queries.streams import _MATCH, _SIDES, _views_and_clicks
from tidegauge.session import scratch
from tidegauge.streaming.backfill import land_together
from tidegauge.streaming.exact import exactly_deduplicated
from tidegauge.streaming.flows import run_flow
from tidegauge.streaming.joins import interval_join
from tidegauge.streaming.late import (
    LATE,
    REJECTED,
    open_windows,
    pending_rows,
    split_late,
    split_rejects,
    split_rows,
)
from tidegauge.streaming.sources import local_clock, stream_table
from tidegauge.streaming.windows import windowed_counts

register = Registry()

_DELAY = "10 minutes"
_MIDDLE = "2024-01-16"


def _halves(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The events before the middle of the month and those after it."""
    middle = F.lit(_MIDDLE).cast("timestamp_ntz")
    return events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)


def _landings(spark: SparkSession, parts: tuple[DataFrame, ...], label: str, run) -> str:
    """Land one part after the other in a new folder, with a run of ``run(stream, folder)`` each."""
    folder = scratch(spark, label)
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/landing")
        run(stream_table(spark, f"{folder}/landing", part.schema), folder)
    return folder


@register(
    "stream_exact_dedup",
    """
    WITH RECURSIVE e AS (SELECT DISTINCT user_id, event_type, ts FROM events),
    kept AS (
        SELECT user_id, event_type, min(ts) AS ts FROM e GROUP BY ALL
        UNION ALL
        SELECT k.user_id, k.event_type, min(e.ts) FROM kept k JOIN e
        ON e.user_id = k.user_id AND e.event_type = k.event_type AND e.ts > k.ts + INTERVAL 1 DAY
        GROUP BY k.user_id, k.event_type
    )
    SELECT user_id, event_type, ts FROM kept
    WHERE ts <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)
    """,
)
def stream_exact_dedup(spark, sf_dir):
    """An event counts unless one of its user and type was kept within the day before; two landings."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")

    def run(stream: DataFrame, folder: str) -> None:
        kept = exactly_deduplicated(stream, "ts", _DELAY, ["user_id", "event_type"], within="1 day")
        run_flow(kept, f"{folder}/checkpoint", "exact", path=f"{folder}/rows")

    folder = _landings(spark, _halves(events), "exact", run)
    return local_clock(spark.read.parquet(f"{folder}/rows"), "ts")


@register(
    "stream_open_windows",
    """
    SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
    FROM (SELECT date_trunc('hour', ts) AS hour, event_type FROM events)
    WHERE hour + INTERVAL 1 HOUR > (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 DAY FROM events)
    GROUP BY hour, event_type
    """,
)
def stream_open_windows(spark, sf_dir):
    """The windows that a count over all events has not closed yet, read from its state."""
    folder = scratch(spark, "open")
    events = stream_table(spark, table_path(sf_dir, "events"))
    counts = windowed_counts(events, "ts", "10 days", "1 hour", ["event_type"])
    run_flow(counts, f"{folder}/checkpoint", "counts", path=f"{folder}/rows")
    still = open_windows(spark, f"{folder}/checkpoint").withColumnRenamed("state_0", "n")
    return local_clock(still, "window_start", "window_end")


@register(
    "stream_pending_rows",
    """
    WITH views AS (SELECT event_id AS view_id, user_id, ts AS view_time
                   FROM events WHERE event_type = 'view'),
    clicks AS (SELECT event_id AS click_id, user_id, ts AS click_time
               FROM events WHERE event_type = 'click')
    SELECT view_id, user_id, view_time FROM views v
    WHERE view_time + INTERVAL 60 MINUTE >= (
        SELECT date_trunc('millisecond', least(max(view_time), (SELECT max(click_time) FROM clicks)))
               - INTERVAL 5 DAY FROM views)
    AND NOT EXISTS (
        FROM clicks c WHERE c.user_id = v.user_id AND c.click_time >= v.view_time
        AND c.click_time <= v.view_time + INTERVAL 60 MINUTE)
    """,
)
def stream_pending_rows(spark, sf_dir):
    """Views that may still get a click, so that an outer join has not let them out."""
    folder = scratch(spark, "pending")
    views, clicks = _views_and_clicks(stream_table(spark, table_path(sf_dir, "events")))
    joined = interval_join(
        views, clicks, ["user_id"], "view_time", "click_time", "60 MINUTES", "5 days", "5 days", "leftOuter"
    )
    rows = joined.select("view_id", "user_id", "view_time", "click_id", "click_time")
    run_flow(rows, f"{folder}/checkpoint", "join", path=f"{folder}/rows")
    out = spark.read.parquet(f"{folder}/rows")
    held = pending_rows(spark, f"{folder}/checkpoint", "left", out, ["view_id"])
    return local_clock(held.select("view_id", "user_id", "view_time"), "view_time")


_LATE_ROWS = f"""
    SELECT event_id, ts, ts < TIMESTAMP '{_MIDDLE}' AND date_trunc('millisecond', ts) <= (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL 20 DAY FROM events) AS late
    FROM events
"""


@register("stream_late_aside", _LATE_ROWS)
def stream_late_aside(spark, sf_dir):
    """The newer half comes first; of the older half, what the watermark has reached is put aside."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")

    def run(stream: DataFrame, folder: str) -> None:
        split_late(stream, "ts", "20 days", f"{folder}/checkpoint", f"{folder}/rows")

    older, newer = _halves(events)
    folder = _landings(spark, (newer, older), "late", run)
    return local_clock(split_rows(spark, f"{folder}/rows", LATE).select("event_id", "ts", LATE), "ts")


_PROPS = "CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END"


@register(
    "stream_rejects",
    """
    SELECT event_id, value >= 99.95 OR event_type = 'error' AS rejected,
        CASE WHEN value < 99.95 THEN CAST(value AS DECIMAL(3, 1)) END AS value,
        CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
        concat_ws('; ', CASE WHEN value >= 99.95 THEN 'value: not decimal(3,1)' END,
            CASE WHEN event_type = 'error' THEN 'props: not k INT' END) AS errors,
        CASE WHEN value >= 99.95 OR event_type = 'error' THEN value END AS raw_value
    FROM events
    """,
)
def stream_rejects(spark, sf_dir):
    """Values with more than two digits before the point and broken JSON go to a quarantine."""
    events = table(spark, sf_dir, "events").selectExpr("event_id", "ts", "value", f"{_PROPS} AS props")

    def run(stream: DataFrame, folder: str) -> None:
        split_rejects(
            stream, f"{folder}/checkpoint", f"{folder}/rows", "rejects",
            casts={"value": "decimal(3,1)"}, json={"props": "k INT"}, required=["event_id"],
        )

    folder = _landings(spark, _halves(events), "rejects", run)
    rows = split_rows(spark, f"{folder}/rows", REJECTED)
    return rows.select(
        "event_id", REJECTED, "value", F.col("props.k").alias("k"),
        F.concat_ws("; ", "_errors").alias("errors"), F.col("_raw.value").alias("raw_value"),
    )


@register(
    "backfill_two_streams",
    f"{_SIDES} SELECT view_id, v.user_id, view_time, click_id, click_time "
    f"FROM views v JOIN clicks c ON {_MATCH}",
)
def backfill_two_streams(spark, sf_dir):
    """Two histories landed slice by slice side by side and joined: the watermark loses no pair."""
    views, clicks = _views_and_clicks(table(spark, sf_dir, "events"))
    folder = scratch(spark, "two-histories")

    def joined(number: int):
        streams = [
            stream_table(spark, f"{folder}/{name}", df.schema) for name, df in (("views", views), ("clicks", clicks))
        ]
        rows = interval_join(
            *streams, ["user_id"], "view_time", "click_time", "60 MINUTES", _DELAY, _DELAY, "inner"
        ).select("view_id", "user_id", "view_time", "click_id", "click_time")
        return run_flow(rows, f"{folder}/checkpoint", f"slice-{number}", path=f"{folder}/rows")

    histories = [(views, "view_time", f"{folder}/views"), (clicks, "click_time", f"{folder}/clicks")]
    land_together(histories, 10 * 24 * 3600, joined)
    return local_clock(spark.read.parquet(f"{folder}/rows"), "view_time", "click_time")
