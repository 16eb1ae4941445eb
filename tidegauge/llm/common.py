"""Small helpers shared by the document operators."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tidegauge
from tidegauge.session import scratch
from tidegauge.sources.files import SharedFiles

# Fixed value: the white space that separates words.
SPACES = " \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per context, wherever the driver runs from.

    The archive lies in the shared folder, from which every executor fetches it.
    """
    context = spark.sparkContext
    if getattr(context, "_tidegauge_shipped", False):
        return
    root, packed = os.path.dirname(os.path.abspath(tidegauge.__file__)), io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.join("tidegauge", os.path.relpath(full, root)))
    path = f"{scratch(spark, 'package')}/tidegauge.zip"
    SharedFiles(spark).write_bytes(path, packed.getvalue())
    context.addPyFile(path)
    context._tidegauge_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written once below the shared folder and read back, which also cuts the lineage."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._staged_at = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in written:
        SharedFiles(df.sparkSession).delete(df._staged_at)


def bounded(ids: DataFrame, most: int = 1_000_000, size: Column | None = None) -> DataFrame:
    """A written table of ids with a broadcast hint where it holds ``most`` of them or fewer.

    It then finds its few rows in a large table without moving that; a longer one is joined by a
    shuffle of both. ``size`` counts the ids of a row, one each by default.
    """
    total = ids.agg(F.sum(F.lit(1) if size is None else size)).first()[0] or 0
    return F.broadcast(ids) if total <= most else ids


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def as_batch(names: list[str], arrays: Iterable[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(arrays), names=names)


def leading(counted: DataFrame, size: int, count: str = "n") -> DataFrame:
    """At most ``size`` rows of the highest counts, without sorting all rows into one task.

    Counts are cut by a bound taken from a histogram of three significant digits; rows that tie with
    the bound are left out rather than some of them chosen.
    """
    digits = F.greatest(F.length(F.col(count).cast("string")) - 3, F.lit(0))
    step = F.pow(F.lit(10), digits).cast("long")
    binned = counted.select((F.floor(F.col(count) / step) * step).cast("long").alias("bin"))
    bins = sorted(binned.groupBy("bin").count().collect(), key=lambda r: -r["bin"])
    bound, rows = None, 0
    for row in bins:
        rows += row["count"]
        if rows > size:
            break
        bound = row["bin"]
    return counted.filter(F.col(count) >= bound) if bound is not None else counted.limit(0)
