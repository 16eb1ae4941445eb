"""Incremental pulls from registered sources, by file or by JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import col
from tidegauge.functions.watermarks import (
    DEFAULT_LOOKBACK_MINUTES,
    check_type,
    jdbc_predicate,
    since,
    watermark_text,
)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("source_system", T.StringType(), False),
        T.StructField("source_table", T.StringType(), False),
        T.StructField("primary_keys", T.StringType(), False),
        T.StructField("watermark_column", T.StringType(), False),
        T.StructField("watermark_type", T.StringType(), False),
        T.StructField("target_table", T.StringType()),
        T.StructField("lookback_minutes", T.IntegerType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)
INGESTED_AT = "_ingested_at"
SOURCE_VALUE = "_source_watermark_value"


@dataclass(frozen=True)
class Source:
    """One row of the source registry; keys are a comma-separated list in the table."""

    source_system: str
    source_table: str
    primary_keys: tuple[str, ...]
    watermark_column: str
    watermark_type: str
    target_table: str
    lookback_minutes: int = DEFAULT_LOOKBACK_MINUTES

    def __post_init__(self):
        check_type(self.watermark_type)


def active_sources(registry: DataFrame) -> list[dict]:
    """Active rows with their defaults filled in; a null flag counts as active."""
    rows = registry.filter(F.coalesce(F.col("is_active"), F.lit(True))).select(
        "source_system",
        "source_table",
        "primary_keys",
        "watermark_column",
        "watermark_type",
        F.coalesce("target_table", "source_table").alias("target_table"),
        F.coalesce("lookback_minutes", F.lit(DEFAULT_LOOKBACK_MINUTES)).alias("lookback_minutes"),
    )
    return [r.asDict() for r in rows.collect()]  # one row per source


def source_of(row: dict) -> Source:
    keys = tuple(k.strip() for k in row["primary_keys"].split(",") if k.strip())
    return Source(**{**row, "primary_keys": keys})


def extract_increment(
    df: DataFrame,
    column: str,
    kind: str,
    watermark: str | None,
    lookback_minutes: int = DEFAULT_LOOKBACK_MINUTES,
) -> DataFrame:
    """Rows past the watermark less the lookback, with lineage columns.

    Without a watermark all rows that have a value in the column: a full load.
    """
    newer = (
        col(column).isNotNull()
        if watermark is None
        else since(df, column, kind, watermark, lookback_minutes)
    )
    return (
        df.filter(newer)
        .withColumn(INGESTED_AT, F.current_timestamp())
        .withColumn(SOURCE_VALUE, watermark_text(df, column))
    )


def jdbc_options(
    url: str,
    source: Source,
    watermark: str | None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a parallel pull; the predicate runs in the source."""
    where = f"{source.watermark_column} IS NOT NULL"
    if watermark is not None:
        where = jdbc_predicate(
            source.watermark_column, source.watermark_type, watermark, source.lookback_minutes
        )
    options = {
        "url": url,
        "dbtable": f"(SELECT * FROM {source.source_table} WHERE {where}) t",
        "fetchsize": str(fetch_size),
    }
    if partitions > 1:
        if partition_column is None or lower is None or upper is None:
            raise ValueError("a parallel pull needs partition_column, lower and upper")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
