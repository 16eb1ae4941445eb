"""Streaming queries: each runs its flow to the end of what is there and reads the result back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.changes import live_rows
from tidegauge.operators.joins import dimension_join, hot_keys
from tidegauge.plans.layers import EventLayers
from tidegauge.queries.base import Registry, table, table_path
from tidegauge.session import scratch
from tidegauge.sources.files import SharedFiles
from tidegauge.sources.versions import VersionedTable
from tidegauge.streaming.backfill import land_in_order
from tidegauge.streaming.dedup import deduplicated
from tidegauge.streaming.flows import (
    FlowRun,
    FlowTarget,
    ResetNotAllowed,
    apply_changes_flow,
    run_flow,
    settings,
    upsert_flow,
)
from tidegauge.streaming.joins import UnboundedStateError, interval_join
from tidegauge.streaming.monitor import (
    dropped_rows,
    late_audit,
    lost_windows,
    store_metrics,
)
from tidegauge.streaming.sources import local_clock, stream_table, watermarked
from tidegauge.streaming.windows import session_counts, windowed_counts, windowed_counts_sql

register = Registry()

_DELAY = "10 minutes"
_DAY = 24 * 60 * 60
_CLOCK = ("window_start", "window_end")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(spark, table_path(sf_dir, "events"))


def _run(stream: DataFrame, label: str, **options) -> tuple[DataFrame, FlowRun]:
    spark = stream.sparkSession
    folder = scratch(spark, label)
    run = run_flow(stream, f"{folder}/checkpoint", label, path=f"{folder}/rows", **options)
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows"), run


def _in_turn(parts: tuple[DataFrame, ...], landing: str, run: Callable[[DataFrame], object]) -> None:
    """Land one part after the other, each with all its tasks, and run what is new after each."""
    for part in parts:
        part.write.mode("append").parquet(landing)
        run(stream_table(part.sparkSession, landing, part.schema))


def _finished(stream: DataFrame, label: str, *clocks: str, **options) -> DataFrame:
    return local_clock(_run(stream, label, **options)[0], *clocks)


# -- windows -----------------------------------------------------------------------------------

# The engine keeps watermarks in whole milliseconds.
_WATERMARK = """(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)"""
_TUMBLING = f"""
    SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
    FROM (SELECT date_trunc('hour', ts) AS hour, event_type FROM events)
    WHERE hour + INTERVAL 1 HOUR <= {_WATERMARK}
    GROUP BY hour, event_type
"""


@register("stream_tumbling", _TUMBLING)
def stream_tumbling(spark, sf_dir):
    counts = windowed_counts(_events(spark, sf_dir), "ts", _DELAY, "1 hour", ["event_type"])
    return _finished(counts, "tumbling", *_CLOCK)


@register("stream_sql_watermark", _TUMBLING)
def stream_sql_watermark(spark, sf_dir):
    events = _events(spark, sf_dir)
    counts = windowed_counts_sql(events, "ts", "10 MINUTES", "1 hour", ["event_type"])
    return _finished(counts, "sql-watermark", *_CLOCK)


@register(
    "stream_sliding",
    f"""
    SELECT start AS window_start, start + INTERVAL 2 HOUR AS window_end, event_type, count(*) AS n
    FROM (
        SELECT event_type, date_trunc('hour', ts) - back * INTERVAL 1 HOUR AS start
        FROM events, (VALUES (0), (1)) steps(back)
    )
    GROUP BY ALL
    HAVING start + INTERVAL 2 HOUR <= {_WATERMARK}
    """,
)
def stream_sliding(spark, sf_dir):
    events = _events(spark, sf_dir)
    counts = windowed_counts(events, "ts", _DELAY, "2 hours", ["event_type"], slide="1 hour")
    return _finished(counts, "sliding", *_CLOCK)


@register(
    "stream_session",
    f"""
    WITH marked AS (
        SELECT user_id, ts,
               CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    ),
    numbered AS (
        SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts
               ROWS UNBOUNDED PRECEDING) AS session FROM marked
    )
    SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, user_id, count(*) AS n
    FROM numbered GROUP BY user_id, session
    HAVING max(ts) + INTERVAL 6 HOUR <= {_WATERMARK}
    """,
)
def stream_session(spark, sf_dir):
    counts = session_counts(_events(spark, sf_dir), "ts", _DELAY, "6 hours", ["user_id"])
    return _finished(counts, "session", *_CLOCK)


@register("stream_two_runs", _TUMBLING)
def stream_two_runs(spark, sf_dir):
    """Two landings, two runs on one checkpoint: the second goes on where the first stopped."""
    events = table(spark, sf_dir, "events")
    folder = scratch(spark, "two-runs")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_table(spark, f"{folder}/landing", events.schema)
        counts = windowed_counts(stream, "ts", _DELAY, "1 hour", ["event_type"])
        run_flow(counts, f"{folder}/checkpoint", "counts", path=f"{folder}/rows")
    return local_clock(spark.read.parquet(f"{folder}/rows"), *_CLOCK)


def _policy_sql(pick: str) -> str:
    return f"""
    SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n
    FROM (SELECT date_trunc('day', ts) AS day, event_type FROM events)
    WHERE event_type IN ('view', 'click') AND day + INTERVAL 1 DAY <= (
        SELECT {pick}(
            date_trunc('millisecond', max(ts) FILTER (event_type = 'view')) - INTERVAL 10 MINUTE,
            date_trunc('millisecond', max(ts) FILTER (event_type = 'click')) - INTERVAL 5 DAY)
        FROM events)
    GROUP BY day, event_type
    """


def _two_watermarks(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    events = _events(spark, sf_dir).select("ts", "event_type")
    views = watermarked(events.filter("event_type = 'view'"), "ts", _DELAY)
    clicks = watermarked(events.filter("event_type = 'click'"), "ts", "5 days")
    grouped = views.union(clicks).groupBy(F.window("ts", "1 day").alias("w"), "event_type")
    counts = grouped.agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n"
    )
    return _finished(counts, f"policy-{policy}", *_CLOCK, watermark_policy=policy)


@register("stream_watermark_min", _policy_sql("least"))
def stream_watermark_min(spark, sf_dir):
    """Two streams, the slower one decides."""
    return _two_watermarks(spark, sf_dir, "min")


@register("stream_watermark_max", _policy_sql("greatest"))
def stream_watermark_max(spark, sf_dir):
    """Two streams, the faster one decides."""
    return _two_watermarks(spark, sf_dir, "max")


# -- deduplication -----------------------------------------------------------------------------


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Every event twice, in two landings and two runs: the second asks the state."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    folder = scratch(spark, "copies")

    def run(stream: DataFrame) -> None:
        rows = deduplicated(stream, "ts", _DELAY, ["event_id"])
        run_flow(rows, f"{folder}/checkpoint", "dedup", path=f"{folder}/rows")

    _in_turn((events, events), f"{folder}/landing", run)
    return local_clock(spark.read.parquet(f"{folder}/rows"), "ts")


# -- joins -------------------------------------------------------------------------------------

_MATCH = """c.user_id = v.user_id AND c.click_time >= v.view_time
        AND c.click_time <= v.view_time + INTERVAL 60 MINUTE"""
_SIDES = """
    WITH views AS (SELECT event_id AS view_id, user_id, ts AS view_time
                   FROM events WHERE event_type = 'view'),
    clicks AS (SELECT event_id AS click_id, user_id, ts AS click_time
               FROM events WHERE event_type = 'click')
"""


def _views_and_clicks(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    kind = F.col("event_type")
    views = events.filter(kind == "view").selectExpr("event_id view_id", "user_id", "ts view_time")
    clicks = events.filter(kind == "click")
    return views, clicks.selectExpr("event_id click_id", "user_id", "ts click_time")


def _interval_join(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    views, clicks = _views_and_clicks(_events(spark, sf_dir))
    joined = interval_join(
        views, clicks, ["user_id"], "view_time", "click_time", "60 MINUTES", _DELAY, _DELAY, how
    )
    rows = joined.select("view_id", "user_id", "view_time", "click_id", "click_time")
    return _finished(rows, f"join-{how}", "view_time", "click_time")


@register(
    "stream_inner_join",
    f"{_SIDES} SELECT view_id, v.user_id, view_time, click_id, click_time "
    f"FROM views v JOIN clicks c ON {_MATCH}",
)
def stream_inner_join(spark, sf_dir):
    return _interval_join(spark, sf_dir, "inner")


@register(
    "stream_left_join",
    f"""{_SIDES}
    SELECT view_id, v.user_id, view_time, click_id, click_time
    FROM views v LEFT JOIN clicks c ON {_MATCH}
    WHERE click_id IS NOT NULL OR view_time + INTERVAL 60 MINUTE < (
        SELECT date_trunc('millisecond', least(max(view_time), (SELECT max(click_time) FROM clicks)))
               - INTERVAL 10 MINUTE FROM views)
    """,
)
def stream_left_join(spark, sf_dir):
    """Unmatched views appear once no click can follow any more."""
    return _interval_join(spark, sf_dir, "leftOuter")


_STATIC = """
    SELECT event_id, ts, event_type, c_name, c_mktsegment
    FROM events LEFT JOIN customer ON user_id = c_custkey
"""


def _static_join(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey user_id", "c_name", "c_mktsegment"
    )
    hot = hot_keys(table(spark, sf_dir, "events"), ["user_id"])
    joined = dimension_join(_events(spark, sf_dir), customers, ["user_id"], hot=hot)
    return _finished(joined.select("event_id", "ts", "event_type", "c_name", "c_mktsegment"), label)


@register(
    "interval_join_days",
    f"""{_SIDES}
    SELECT view_id, click_id FROM views v JOIN clicks c
    ON c.user_id = v.user_id AND c.click_time >= v.view_time
        AND c.click_time <= v.view_time + INTERVAL 24 HOUR
    """,
)
def interval_join_days(spark, sf_dir):
    """A bound of a day, which counts as 24 hours, with busy keys salted; from tables at rest."""
    views, clicks = _views_and_clicks(table(spark, sf_dir, "events"))
    joined = interval_join(
        views, clicks, ["user_id"], "view_time", "click_time", "1 DAY", _DELAY, _DELAY, "inner", 4
    )
    return joined.select("view_id", "click_id")


@register("stream_static_join", _STATIC)
def stream_static_join(spark, sf_dir):
    """Events beside the customer table, which is read in full at every run."""
    return _static_join(spark, sf_dir, "static-join")


# -- targets, layers and upserts ---------------------------------------------------------------


@register(
    "two_flows_one_target",
    """
    SELECT event_id, ts, user_id, event_type AS flow FROM events
    WHERE event_type IN ('view', 'click')
    """,
)
def two_flows_one_target(spark, sf_dir):
    target = FlowTarget(spark, scratch(spark, "two-flows"))
    events = _events(spark, sf_dir)
    for kind in ("view", "click"):
        rows = events.filter(F.col("event_type") == kind).select("event_id", "ts", "user_id")
        target.append(kind, rows)
    return target.read()


@register(
    "full_refresh",
    "SELECT event_id, event_type, 'raw' AS flow, value * 2 AS value FROM events",
)
def full_refresh(spark, sf_dir):
    """A flow whose logic changed: its output is rebuilt from the source."""
    target = FlowTarget(spark, scratch(spark, "refresh"))
    events = _events(spark, sf_dir).select("event_id", "event_type", "value")
    target.append("raw", events, logic="1")
    target.append("raw", events.withColumn("value", F.col("value") * 2), logic="2")
    return target.read()


@register(
    "reset_keeps_data",
    """
    SELECT 'reset' AS step, 2 * count(*) AS n, count(DISTINCT event_id) AS ids, FALSE AS refused
    FROM events
    UNION ALL SELECT 'guarded', count(*), count(*), TRUE FROM events
    """,
)
def reset_keeps_data(spark, sf_dir):
    """A reset checkpoint reads its source again beside the data it keeps; a guard forbids resets."""
    events = _events(spark, sf_dir).select("event_id", "event_type")
    steps = []
    for step, allowed in (("reset", True), ("guarded", False)):
        target, refused = FlowTarget(spark, scratch(spark, step), allowed), False
        target.append("raw", events)
        try:
            target.reset_checkpoint("raw")
        except ResetNotAllowed:
            refused = True
        target.append("raw", events)
        steps.append(
            target.read().agg(
                F.lit(step).alias("step"),
                F.count(F.lit(1)).alias("n"),
                F.count_distinct("event_id").alias("ids"),
                F.lit(refused).alias("refused"),
            )
        )
    return steps[0].unionAll(steps[1])


@register(
    "unbounded_joins_refused",
    """
    SELECT error, n, (SELECT count(*) FROM events) AS events
    FROM (VALUES ('no time bound between the streams', 1),
                 ('no watermark on the left and right stream', 2),
                 ('no watermark on the right stream', 3)) v(error, n)
    """,
)
def unbounded_joins_refused(spark, sf_dir):
    """What a stream-stream join without watermarks or a bound is told."""
    views, clicks = _views_and_clicks(_events(spark, sf_dir))
    errors = []
    for n, bounds in enumerate(((_DELAY, _DELAY, ""), ("", "", "1 HOUR"), (_DELAY, None, "1 HOUR")), 1):
        left, right, within = bounds
        try:
            interval_join(views, clicks, ["user_id"], "view_time", "click_time", within, left, right)
        except UnboundedStateError as error:
            errors.append((str(error), n))
    told = spark.createDataFrame(errors, "error string, n int")
    events = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("events")).first()[0]
    return told.withColumn("events", F.lit(events))


@register(
    "backfill_wide_threshold",
    """
    SELECT hour AS window_start, event_type, count(*) AS n
    FROM (SELECT date_trunc('hour', ts) AS hour, event_type FROM events)
    WHERE hour + INTERVAL 1 HOUR <= (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL 20 DAY FROM events)
    GROUP BY hour, event_type
    """,
)
def backfill_wide_threshold(spark, sf_dir):
    """Files newest first, with a delay wider than the history of the open windows: none is late."""
    events = table(spark, sf_dir, "events")
    landing = scratch(spark, "wide")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    landed = [0]
    for part in (events.filter(F.col("ts") >= middle), events.filter(F.col("ts") < middle)):
        part.write.mode("append").parquet(landing)
        landed.append(len([n for n in SharedFiles(spark).children(landing) if n.endswith(".parquet")]))
    # Two micro-batches, the second one with the rest of the older files.
    most = max(after - before for before, after in zip(landed, landed[1:]))
    stream = stream_table(spark, landing, events.schema, max_files=most)
    counts = windowed_counts(stream, "ts", "20 days", "1 hour", ["event_type"])
    return _finished(counts.drop("window_end"), "wide", "window_start")


@register("stream_static_join_salted", _STATIC)
def stream_static_join_salted(spark, sf_dir):
    """The same join where the table is too big to broadcast."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        return _static_join(spark, sf_dir, "static-join-salted")


@register(
    "stream_layers",
    f"""
    SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n,
           CAST(sum(k) AS BIGINT) AS k_sum
    FROM (SELECT date_trunc('hour', ts) AS hour, event_type,
                 CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
    WHERE hour + INTERVAL 1 HOUR <= {_WATERMARK}
    GROUP BY hour, event_type
    """,
)
def stream_layers(spark, sf_dir):
    """Bronze, silver and gold; two landings, two passes, one file per micro-batch."""
    events = table(spark, sf_dir, "events")
    landing = scratch(spark, "landing")
    layers = EventLayers(spark)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(landing)
        layers.run(stream_table(spark, landing, events.schema, max_files=1), _DELAY, "1 hour")
    return local_clock(layers.gold.read().drop("flow"), *_CLOCK)


_LATEST = """
    SELECT user_id, event_id, ts, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1
"""


def _by_type(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """The events in several parts, one event type after the other."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    kinds = (("view", "click"), ("purchase",), ("signup", "error"))
    return tuple(events.filter(F.col("event_type").isin(*k)) for k in kinds)


@register("stream_upsert", _LATEST)
def stream_upsert(spark, sf_dir):
    """Micro-batches upserted by user, the newest events first; all are sent again after a reset.

    What a later batch brings of an older time must not replace the stored row.
    """
    source = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    folder = scratch(spark, "upserts")
    edges = [F.lit(f"2024-01-{d:02d}").cast("timestamp_ntz") for d in (21, 11)]
    newest_first = (
        source.filter(F.col("ts") >= edges[0]),
        source.filter((F.col("ts") < edges[0]) & (F.col("ts") >= edges[1])),
        source.filter(F.col("ts") < edges[1]),
    )
    stored = VersionedTable(spark, f"{folder}/table", F.floor(F.col("user_id") / 100_000))

    def run(events: DataFrame, attempt: str = "first") -> None:
        checkpoint = f"{folder}/checkpoint-{attempt}"
        upsert_flow(events, stored, ["user_id"], ["ts", "event_id"], checkpoint, attempt)

    _in_turn(newest_first, f"{folder}/landing", run)
    run(stream_table(spark, f"{folder}/landing", source.schema), "reset")
    return stored.read()


@register("stream_apply_changes", f"{_LATEST} AND event_type <> 'signup'")
def stream_apply_changes(spark, sf_dir):
    """Changes that arrive out of order, in three micro-batches, applied by sequence."""
    folder = scratch(spark, "changes")
    stored = VersionedTable(spark, f"{folder}/table", F.floor(F.col("user_id") / 100_000))

    def run(stream: DataFrame) -> None:
        apply_changes_flow(
            stream,
            stored,
            ["user_id"],
            ["ts", "event_id"],
            f"{folder}/checkpoint",
            "changes",
            delete_when=F.col("event_type") == "signup",
        )

    _in_turn(_by_type(spark, sf_dir), f"{folder}/landing", run)
    return live_rows(stored.read())


# -- backfill and audits -----------------------------------------------------------------------


@register("backfill_ordered", _TUMBLING)
def backfill_ordered(spark, sf_dir):
    """A history whose files came newest first, streamed in event-time order without losses."""
    events = table(spark, sf_dir, "events")
    folder = scratch(spark, "backfill")
    days = [F.lit(f"2024-01-{d:02d}").cast("timestamp_ntz") for d in (21, 11)]
    newest_first = (
        events.filter(F.col("ts") >= days[0]),
        events.filter((F.col("ts") < days[0]) & (F.col("ts") >= days[1])),
        events.filter(F.col("ts") < days[1]),
    )
    for part in newest_first:
        part.write.mode("append").parquet(f"{folder}/history")
    landing = f"{folder}/landing"

    def after_slice(number: int) -> FlowRun:
        stream = stream_table(spark, landing, events.schema)
        counts = windowed_counts(stream, "ts", _DELAY, "1 hour", ["event_type"])
        return run_flow(counts, f"{folder}/checkpoint", f"slice-{number}", path=f"{folder}/rows")

    history = spark.read.schema(events.schema).parquet(f"{folder}/history")
    land_in_order(history, "ts", 10 * _DAY, landing, after_slice)
    return local_clock(spark.read.parquet(f"{folder}/rows"), *_CLOCK)


_LATE_EVENTS = """
    event_type = 'error' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events
        WHERE event_type <> 'error')
"""


def _late_errors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, FlowRun]:
    """Hourly counts by user where all errors arrive after the other events were counted."""
    events = table(spark, sf_dir, "events")
    folder = scratch(spark, "late")
    is_error = F.col("event_type") == "error"
    for part in (events.filter(~is_error), events.filter(is_error)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_table(spark, f"{folder}/landing", events.schema)
        counts = windowed_counts(stream, "ts", _DELAY, "1 hour", ["event_type"])
        run = run_flow(counts, f"{folder}/checkpoint", "late", path=f"{folder}/rows")
    return events, local_clock(spark.read.parquet(f"{folder}/rows"), *_CLOCK), run


@register(
    "late_dropped",
    f"SELECT event_id, ts, event_type FROM events WHERE {_LATE_EVENTS}",
)
def late_dropped(spark, sf_dir):
    """The late rows themselves: bronze rows whose closed window never had them counted."""
    events, counted, run = _late_errors(spark, sf_dir)
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    closed = F.lit(run.watermark).cast("timestamp").cast("timestamp_ntz")
    due = events.withColumn("window_start", hour).filter(
        F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= closed
    )
    lost = dropped_rows(due, counted, ["window_start", "event_type"])
    return lost.select("event_id", "ts", "event_type")


_PARTLY_LATE = "(event_type = 'error' OR (event_type = 'view' AND user_id % 2 = 0))"


@register(
    "late_lost_windows",
    f"""
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS lost FROM events
    WHERE {_PARTLY_LATE} AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events
        WHERE NOT {_PARTLY_LATE})
    GROUP BY ALL
    """,
)
def late_lost_windows(spark, sf_dir):
    """What closed windows are short of, also where some of their rows came in time."""
    events = table(spark, sf_dir, "events")
    folder = scratch(spark, "partly-late")
    for part in (events.filter(f"NOT {_PARTLY_LATE}"), events.filter(_PARTLY_LATE)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_table(spark, f"{folder}/landing", events.schema)
        counts = windowed_counts(stream, "ts", _DELAY, "1 hour", ["event_type"])
        run = run_flow(counts, f"{folder}/checkpoint", "late", path=f"{folder}/rows")
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("window_start")
    due = events.groupBy(hour, "event_type").agg(F.count(F.lit(1)).alias("n"))
    closed = F.lit(run.watermark).cast("timestamp").cast("timestamp_ntz")
    due = due.filter(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= closed)
    found = local_clock(spark.read.parquet(f"{folder}/rows"), *_CLOCK)
    return lost_windows(due, found, ["window_start", "event_type"])


@register(
    "late_audit",
    """
    SELECT ts < TIMESTAMP '2024-01-20 12:00:00' AS late, count(*) AS rows, min(ts) AS earliest,
           max(ts) AS latest
    FROM events GROUP BY ALL
    """,
)
def late_audit_query(spark, sf_dir):
    audit = late_audit(table(spark, sf_dir, "events"), "ts", "2024-01-20 12:00:00")
    return local_clock(audit, "earliest", "latest")


@register(
    "stream_metrics",
    f"""
    SELECT 'late' AS flow, count(*) AS input_rows,
           count(*) FILTER ({_LATE_EVENTS}) > 0 AS dropped_some,
           strftime((SELECT date_trunc('millisecond', max(ts)) FROM events
                     WHERE event_type <> 'error') - INTERVAL 10 MINUTE,
                    '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS watermark
    FROM events
    """,
)
def stream_metrics(spark, sf_dir):
    """The stored metrics of two runs of a flow, the second of which drops late rows."""
    events = table(spark, sf_dir, "events")
    folder = scratch(spark, "metrics")
    is_error = F.col("event_type") == "error"
    for part in (events.filter(~is_error), events.filter(is_error)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_table(spark, f"{folder}/landing", events.schema)
        counts = windowed_counts(stream, "ts", _DELAY, "1 hour", ["event_type"])
        run = run_flow(counts, f"{folder}/checkpoint", "late", path=f"{folder}/rows")
        stored = store_metrics(spark, [run], f"{folder}/metrics")
    return stored.groupBy("flow").agg(
        F.sum("input_rows").alias("input_rows"),
        (F.sum("rows_dropped") > 0).alias("dropped_some"),
        F.max("watermark").alias("watermark"),
    )
