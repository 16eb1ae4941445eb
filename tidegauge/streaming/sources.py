"""File-backed streaming tables: each file is taken once, tracked by the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import as_instant, col
from tidegauge.sources.files import SharedFiles


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """A table directory, or a single file, as a stream.

    ``max_files`` limits the files per micro-batch; without it a run takes all that is there.
    """
    if schema is None:
        schema = spark.read.format(file_format).load(path).schema
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(_listable(spark, path))


def _listable(spark: SparkSession, path: str) -> str:
    # The file source wants a directory or a pattern; a one-name pattern also matches a file.
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}" if SharedFiles(spark).is_file(path) else path


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """The column as TIMESTAMP, in place."""
    return df.withColumn(column, as_instant(col(column)))


def watermarked(df: DataFrame, column: str, delay: str) -> DataFrame:
    """``df`` with an event-time watermark; the column is cast to TIMESTAMP where needed."""
    if not isinstance(df.schema[column].dataType, T.TimestampType):
        df = with_event_time(df, column)
    return df.withWatermark(column, delay)


def local_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Event times back as TIMESTAMP_NTZ, the type they had before ``watermarked``."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
