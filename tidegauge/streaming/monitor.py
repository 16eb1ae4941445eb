"""Flow metrics as a table, and audits of what a watermark dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import as_instant, col, cols
from tidegauge.operators.changes import missing_rows
from tidegauge.streaming.flows import FlowRun

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("flow", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("max_event_time", T.StringType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("state_bytes", T.LongType()),
        T.StructField("rows_dropped", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)


def flow_metrics(spark: SparkSession, runs: list[FlowRun]) -> DataFrame:
    """One row per micro-batch: input, watermark, state and dropped rows."""
    rows = []
    for run in runs:
        for p in run.progress:
            state, times = p.get("stateOperators", []), p.get("eventTime", {})
            rows.append(
                (
                    run.flow,
                    p["batchId"],
                    p["timestamp"],
                    p["numInputRows"],
                    times.get("max"),
                    times.get("watermark"),
                    sum(op["numRowsTotal"] for op in state),
                    sum(op["memoryUsedBytes"] for op in state),
                    sum(op["numRowsDroppedByWatermark"] for op in state),
                    p.get("durationMs", {}).get("triggerExecution"),
                )
            )
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def store_metrics(spark: SparkSession, runs: list[FlowRun], path: str) -> DataFrame:
    """Append the runs' metrics to a Parquet table and return the whole table."""
    flow_metrics(spark, runs).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(METRICS_SCHEMA).parquet(path)


def lost_windows(expected: DataFrame, found: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Rows that late data is short of, per window and key: ``lost`` is expected minus found.

    A window that has some of its rows is reported with the rest, one that never closed as a whole.
    """
    theirs = found.select(*[col(k).alias(f"_found_{i}") for i, k in enumerate(keys)], col(count).alias("_found"))
    match = [col(k).eqNullSafe(F.col(f"_found_{i}")) for i, k in enumerate(keys)]
    joined = expected.join(theirs, reduce(Column.__and__, match), "left")
    lost = col(count) - F.coalesce("_found", F.lit(0))
    return joined.select(*cols(keys), lost.alias("lost")).filter("lost != 0")


def late_audit(bronze: DataFrame, event_time: str, watermark: str) -> DataFrame:
    """How many bronze rows lie within and beyond a watermark, with their event-time range."""
    time = as_instant(col(event_time))
    marked = bronze.withColumn("late", time < F.lit(watermark).cast("timestamp"))
    return marked.groupBy("late").agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("earliest"), F.max(time).alias("latest")
    )


def dropped_rows(bronze: DataFrame, silver: DataFrame, keys: list[str]) -> DataFrame:
    """The bronze rows that never reached silver."""
    return missing_rows(bronze, silver, keys)
