"""Chained layers: raw append, row-level cleaning, watermarked aggregate, recomputed views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import scratch
from tidegauge.streaming.flows import FlowRun, FlowTarget
from tidegauge.streaming.sources import stream_table
from tidegauge.streaming.windows import windowed_counts

PROPS_SCHEMA = "k INT"


def clean_events(raw: DataFrame) -> DataFrame:
    """Row-level silver transform: parse the properties, cast, and drop rows without a key."""
    return raw.filter(F.col("event_id").isNotNull() & F.col("ts").isNotNull()).select(
        "event_id",
        "ts",
        "user_id",
        F.lower(F.trim("event_type")).alias("event_type"),
        F.col("value").try_cast("decimal(18,2)").alias("amount"),
        F.from_json("props", PROPS_SCHEMA)["k"].alias("k"),
    )


@dataclass
class LayerRun:
    bronze: FlowRun
    silver: FlowRun
    gold: FlowRun


class EventLayers:
    """Bronze takes files as they are, silver cleans rows, gold counts closed windows."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        root = root or scratch(spark, "layers")
        self.bronze = FlowTarget(spark, f"{root}/bronze")
        self.silver = FlowTarget(spark, f"{root}/silver")
        self.gold = FlowTarget(spark, f"{root}/gold")

    def _stream_of(self, layer: FlowTarget, flow: str) -> DataFrame:
        folder = layer.data_folder(flow, layer.state(flow)["current"])
        return stream_table(self.spark, folder)

    def run(self, source: DataFrame, delay: str, size: str) -> LayerRun:
        """One pass of all three flows over what is new."""
        bronze = self.bronze.append("events", source)
        silver = self.silver.append("clean", clean_events(self._stream_of(self.bronze, "events")))
        cleaned = self._stream_of(self.silver, "clean")
        gold = self.gold.append(
            "counts",
            windowed_counts(
                cleaned,
                "ts",
                delay,
                size,
                ["event_type"],
                measures={"n": F.count(F.lit(1)), "k_sum": F.sum("k")},
            ),
        )
        return LayerRun(bronze, silver, gold)

