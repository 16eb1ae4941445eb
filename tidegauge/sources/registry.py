"""The lists that say which datasets to profile: registry, control table and governed config."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import DEFAULT_BRANCH, branch_or_default
from tidegauge.sources.datasets import DatasetRef, list_files

# The schemas of the registry, the control table and the config.
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("rid", T.StringType()),
        T.StructField("dataset_path", T.StringType()),
        T.StructField("branch", T.StringType()),
    ]
)

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("rid", T.StringType(), nullable=False),
        T.StructField("path", T.StringType(), nullable=False),
        T.StructField("branch", T.StringType(), nullable=True),
        T.StructField("enabled", T.BooleanType(), nullable=True),
        T.StructField("added_at", T.TimestampType(), nullable=True),
        T.StructField("added_by", T.StringType(), nullable=True),
        T.StructField("notes", T.StringType(), nullable=True),
    ]
)

_CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("hostname", T.StringType()),
        T.StructField(
            "governed_datasets",
            T.ArrayType(
                T.StructType(
                    [T.StructField("rid", T.StringType()), T.StructField("path", T.StringType())]
                )
            ),
        ),
        T.StructField("output_rid", T.StringType()),
        T.StructField("adhoc_control_rid", T.StringType()),
        T.StructField("adhoc_output_rid", T.StringType()),
    ]
)


def build_control_table(spark: SparkSession, rows: list[dict | Row]) -> DataFrame:
    """Control rows that are enabled; a null flag counts as not enabled."""
    return only_enabled(spark.createDataFrame(rows, CONTROL_SCHEMA))


def control_from_folder(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Control rows from a folder scan: one per dataset file or dataset directory in the folder."""
    root = folder.rstrip("/")
    qualified = _qualified(spark, root)
    # The root is cut off once, from the front: its text may occur again below it.
    inside = F.substr("path", F.lit(len(qualified) + 2))
    files = list_files(spark, root, pattern).withColumn("name", F.split_part(inside, F.lit("/"), F.lit(1)))
    found = files.groupBy("name").agg(F.min("modificationTime").alias("added_at"))
    return found.select(
        F.col("name").alias("rid"),
        F.col("name").alias("path"),
        F.lit(DEFAULT_BRANCH).alias("branch"),
        F.lit(True).alias("enabled"),
        "added_at",
        F.lit("folder scan").alias("added_by"),
        F.lit(None).cast("string").alias("notes"),
    )


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, the way file listings show it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop.getFileSystem(conf).makeQualified(hadoop).toString().rstrip("/")


def only_enabled(control: DataFrame) -> DataFrame:
    """Enabled rows where the table has the flag, all rows where it has not."""
    return control.filter(F.col("enabled")) if "enabled" in control.columns else control


def normalise_listing(listing: DataFrame, path_column: str) -> DataFrame:
    """``rid, path, branch`` with the branch defaulted where it is null, empty or missing."""
    branch = F.col("branch") if "branch" in listing.columns else F.lit(None).cast("string")
    return only_enabled(listing).select(
        "rid", F.col(path_column).alias("path"), branch_or_default(branch).alias("branch")
    )


def _refs(listing: DataFrame) -> list[DatasetRef]:
    # One row per dataset to profile, never per data row.
    return [DatasetRef(r["rid"], r["path"], r["branch"]) for r in listing.collect()]


def registry_refs(registry: DataFrame) -> list[DatasetRef]:
    return _refs(normalise_listing(registry, "dataset_path"))


def control_refs(control: DataFrame) -> list[DatasetRef]:
    return _refs(normalise_listing(control, "path"))


@dataclass(frozen=True)
class GovernedConfig:
    governed: list[DatasetRef]
    output_rid: str
    adhoc_control_rid: str | None
    adhoc_output_rid: str

    @property
    def has_adhoc(self) -> bool:
        return bool(self.adhoc_control_rid)


def governed_datasets(spark: SparkSession, path: str) -> DataFrame:
    """The governed list of a JSON config as ``rid, path, branch``."""
    config = spark.read.schema(_CONFIG_SCHEMA).option("multiLine", True).json(path)
    entries = config.select(F.explode("governed_datasets").alias("d")).select("d.*")
    return entries.withColumn("branch", F.lit(DEFAULT_BRANCH))


def read_config(spark: SparkSession, path: str) -> GovernedConfig:
    """List and output ids; the ad-hoc output falls back to the governed output."""
    ids = spark.read.schema(_CONFIG_SCHEMA).option("multiLine", True).json(path).first()
    if ids is None or not ids["output_rid"]:
        raise ValueError(f"{path} names no output_rid")
    return GovernedConfig(
        governed=_refs(governed_datasets(spark, path)),
        output_rid=ids["output_rid"],
        adhoc_control_rid=ids["adhoc_control_rid"],
        adhoc_output_rid=ids["adhoc_output_rid"] or ids["output_rid"],
    )
