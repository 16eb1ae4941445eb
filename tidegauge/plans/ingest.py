"""High-watermark ingestion: read watermark, extract, write target, then move the watermark.

An increment is written once to the shared folder, with its row count and new watermark observed
during that write, and upserted from there: the source is read once. A first full load is not
copied like that; it goes straight into the target, up to the watermark found beforehand.

The watermark moves last; a run that dies before that reads the same rows again and the upsert
puts them in place a second time without effect.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime, timezone
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import col
from tidegauge.functions.watermarks import later, watermark_text
from tidegauge.operators.changes import latest_per_key
from tidegauge.plans.tables import upsert_table
from tidegauge.session import scratch
from tidegauge.sources.increments import Source, active_sources, extract_increment, source_of
from tidegauge.sources.versions import VersionedTable

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("source_system", T.StringType(), False),
        T.StructField("source_table", T.StringType(), False),
        T.StructField("watermark_column", T.StringType(), False),
        T.StructField("watermark_value", T.StringType(), False),
        T.StructField("watermark_type", T.StringType(), False),
        T.StructField("last_run_status", T.StringType()),
        T.StructField("last_run_timestamp", T.TimestampType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("updated_by", T.StringType()),
    ]
)

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("source_system", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("rows_without_watermark", T.LongType()),
        T.StructField("watermark_value", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass
class RunStatus:
    source_system: str
    source_table: str
    status: str
    rows_processed: int = 0
    rows_without_watermark: int | None = 0
    watermark_value: str | None = None
    error: str | None = None


def _of(system: str, table: str) -> Column:
    return (F.col("source_system") == system) & (F.col("source_table") == table)


def _current(table: VersionedTable) -> DataFrame | None:
    return None if table.latest() is None else table.read()


def read_watermark(control: DataFrame | None, system: str, table: str) -> str | None:
    """The stored watermark text, or None before the first run."""
    if control is None:
        return None
    row = control.filter(_of(system, table)).select("watermark_value").first()
    return None if row is None else row[0] or None


def commit_watermark(
    control: VersionedTable, source: Source, value: str, status: str, rows: int, by: str
) -> int:
    """Write the source's control row; the value never goes back."""
    with _alone(control):
        return _committed(control, source, value, status, rows, by)


def _alone(control):
    return getattr(control, "gate", None) or nullcontext()


def mark_failed(
    control: VersionedTable, run: RunStatus, by: str, source: Source | None = None
) -> int | None:
    """Record a failed run in the source's control row, which keeps its watermark.

    A source whose first run fails gets a row with an empty watermark, if ``source`` is known.
    """
    with _alone(control):
        current = _current(control)
        mine = _of(run.source_system, run.source_table)
        if current is None or current.filter(mine).isEmpty():
            return None if source is None else _committed(control, source, None, "failed", 0, by)
        changed = {
            "last_run_status": F.lit("failed"),
            "last_run_timestamp": F.lit(datetime.now(timezone.utc)),
            "rows_processed": F.lit(0).cast("long"),
            "updated_by": F.lit(by),
        }
        rows = current.withColumns({n: F.when(mine, v).otherwise(F.col(n)) for n, v in changed.items()})
        return control.publish(rows.coalesce(1))


def _committed(
    control: VersionedTable, source: Source, value: str | None, status: str, rows: int, by: str
) -> int:
    current = _current(control)
    stored = read_watermark(current, source.source_system, source.source_table)
    row = (
        source.source_system,
        source.source_table,
        source.watermark_column,
        # The column takes no null; before the first success it is empty.
        later(stored, value, source.watermark_type) or "",
        source.watermark_type,
        status,
        datetime.now(timezone.utc),
        rows,
        by,
    )
    update = control.spark.createDataFrame([row], WATERMARK_SCHEMA)
    merged = update
    if current is not None:
        merged = current.filter(~_of(source.source_system, source.source_table)).unionByName(update)
    return control.publish(merged.coalesce(1))


def _staged(rows: DataFrame, column: str, folder: str, seen: Observation) -> tuple[DataFrame, int, object]:
    """The rows as a written table, their number and their highest watermark."""
    # The observed stage is the writing one, where a repeated task is not counted twice.
    rows.observe(seen, *_summary(column)).write.parquet(folder)
    staged = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    return staged, seen.get["rows"], seen.get["highest"]


def _summary(column: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.max(col(column)).alias("highest")]


def _as_text(df: DataFrame, column: str, value: object) -> str | None:
    """An extracted watermark in the stored text form."""
    if value is None:
        return None
    one = df.sparkSession.createDataFrame([(value,)], T.StructType([df.schema[column]]))
    return one.select(watermark_text(one, column)).first()[0]


def ingest_source(
    source: Source,
    df: DataFrame,
    target: VersionedTable,
    control: VersionedTable,
    updated_by: str = "tidegauge",
    count_unmarked: bool | None = None,
    logic: str | None = None,
    keep: int | None = None,
) -> RunStatus:
    """One incremental run of one source.

    If ``logic`` is given and differs from the one the target was built with, the run falls back
    to a full load that replaces the target.

    ``count_unmarked`` reports the rows without a watermark value, which are never extracted. It
    costs a scan of that column and by default happens in full loads only. With ``keep`` only that
    many versions of the target stay.
    """
    system, table, column = source.source_system, source.source_table, source.watermark_column
    keys = list(source.primary_keys)
    stored = read_watermark(_current(control), system, table)
    built = target.version()
    full = built is None or (logic is not None and built.logic != logic)
    counting = full if count_unmarked is None else count_unmarked
    since = None if full else stored
    missing = Observation()
    if full and counting:
        # The rows without a watermark are seen in the one reading of the source.
        df = df.observe(missing, F.count_if(col(column).isNull()).alias("rows"))
    rows = extract_increment(df, column, source.watermark_type, since, source.lookback_minutes)

    staging = scratch(df.sparkSession, "increment")
    staged, count, highest = _staged(rows, column, staging, Observation())
    unmarked = None
    if counting:
        unmarked = missing.get["rows"] if full else df.filter(col(column).isNull()).count()
    if count and full:
        target.publish(latest_per_key(staged, keys, [column]), logic=logic)
    elif count:
        upsert_table(target, staged, keys, [column])
    value = later(stored, _as_text(df, column, highest), source.watermark_type)
    if value is not None:
        commit_watermark(control, source, value, "success", count, updated_by)
    control.files.delete(staging)
    if keep is not None:
        target.expire(keep)
    return RunStatus(system, table, "success", count, unmarked, value)


def ingest(
    registry: DataFrame,
    read: Callable[[Source], DataFrame],
    targets: Callable[[Source], VersionedTable],
    control: VersionedTable,
    updated_by: str = "tidegauge",
    logic: Callable[[Source], str | None] | None = None,
    threads: int = 4,
    count_unmarked: bool | None = None,
    keep: int | None = 10,
) -> DataFrame:
    """Run all active sources, one status row each; a failing source does not stop the others.

    Sources run side by side; the control table has one writer at a time. A run that fails keeps its
    watermark and is recorded as ``failed`` in the control table, if the source has a row there.
    ``logic`` gives each source's logic version, ``keep`` the versions that targets and the control
    table retain.
    """
    gate = Lock()
    guarded = _Guarded(control, gate)

    def one(row) -> RunStatus:
        source = None
        try:
            source = source_of(row)
            version = None if logic is None else logic(source)
            return ingest_source(
                source,
                read(source),
                targets(source),
                guarded,
                updated_by,
                count_unmarked,
                version,
                keep,
            )
        except Exception as error:  # recorded; the watermark stays where it was
            failed = RunStatus(row["source_system"], row["source_table"], "failed")
            failed.error = str(error)
            mark_failed(guarded, failed, updated_by, source)
            return failed

    rows = active_sources(registry)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(rows)))) as pool:
        statuses = list(pool.map(one, rows))
    if keep is not None:
        control.expire(keep)
    return status_table(control.spark, statuses)


class _Guarded:
    """The control table of runs side by side: whoever changes it reads and writes alone."""

    def __init__(self, table: VersionedTable, gate: Lock):
        self.table, self.gate = table, gate

    def __getattr__(self, name: str):
        return getattr(self.table, name)


def status_table(spark: SparkSession, statuses: list[RunStatus]) -> DataFrame:
    return spark.createDataFrame([vars(s) for s in statuses], STATUS_SCHEMA)
