"""Datasets by id and branch, resolved to (format, path, options) when they are read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegauge.functions.columns import DEFAULT_BRANCH

DISTRICT_SCHEMA = T.StructType(
    [
        T.StructField("district_id", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("state_name", T.StringType()),
        T.StructField("state_abbrev", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("division", T.StringType()),
    ]
)


@dataclass(frozen=True)
class DatasetRef:
    """One listed dataset: an id, the path it is known by, and a branch."""

    rid: str
    path: str
    branch: str = DEFAULT_BRANCH


@dataclass
class Location:
    """Where a dataset's files lie."""

    path: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path)


class Catalog:
    """Maps ``(rid, branch)`` to a location.

    Ids that were not registered are read as Parquet below ``root``: ``root/<branch>/<path>``, or
    ``root/<path>`` for the default branch.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self._known: dict[tuple[str, str], Location | str] = {}

    def add(self, rid: str, location: Location, branch: str = DEFAULT_BRANCH) -> Catalog:
        self._known[(rid, branch)] = location
        return self

    def add_table(self, rid: str, table: str, branch: str = DEFAULT_BRANCH) -> Catalog:
        self._known[(rid, branch)] = table
        return self

    def dataframe(self, rid: str, branch: str = DEFAULT_BRANCH, path: str | None = None) -> DataFrame:
        known = self._known.get((rid, branch))
        if isinstance(known, str):
            return self.spark.table(known)
        if known is not None:
            return known.read(self.spark)
        if self.root is None or not path:
            raise LookupError(f"no dataset {rid} on branch {branch}")
        below = path.strip("/") if branch == DEFAULT_BRANCH else f"{branch}/{path.strip('/')}"
        return Location(f"{self.root}/{below}").read(self.spark)

    def read(self, ref: DatasetRef) -> DataFrame:
        return self.dataframe(ref.rid, ref.branch, ref.path)


def read_districts(spark: SparkSession, path: str) -> DataFrame:
    """The district dimension: a CSV with a header; line ends may be CRLF."""
    return spark.read.schema(DISTRICT_SCHEMA).option("header", True).csv(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths, sizes and times of the files below a folder; the contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    return files.select("path", "length", "modificationTime")
