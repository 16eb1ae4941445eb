"""Profile jobs over many datasets: registry-driven, governed and ad-hoc.

Each dataset's profile is written to a staging folder of its own, inside a ``try``: that write is
the action, so a bad dataset fails alone. The staged profiles (one row per column) are then read
back as one table, joined with the dataset metadata, tagged and published.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from threading import Event, Timer

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import DEFAULT_BRANCH, tag
from tidegauge.operators.profile import PROFILE_SCHEMA, profile_dataframe
from tidegauge.session import scratch, shared_root
from tidegauge.sources.datasets import Catalog, DatasetRef
from tidegauge.sources.files import SharedFiles
from tidegauge.sources.registry import GovernedConfig, control_refs, registry_refs
from tidegauge.sources.versions import VersionedTable

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("source_rid", T.StringType()),
        T.StructField("schema_branch", T.StringType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("last_modified", T.StringType()),
        T.StructField("last_transaction_rid", T.StringType()),
    ]
)
FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("rid", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_STAGED_SCHEMA = T.StructType(
    [
        *PROFILE_SCHEMA.fields,
        T.StructField("profiling_mode", T.StringType()),
        T.StructField("schema_branch", T.StringType()),
    ]
)
_METRICS = PROFILE_SCHEMA.names[:16]
NARROW_COLUMNS = [
    *PROFILE_SCHEMA.names,
    "build_timestamp",
    "total_datasets_profiled",
    "total_datasets_failed",
]
WIDE_COLUMNS = [
    *_METRICS,
    "source_rid",
    "dataset_path",
    "profiling_mode",
    "dataset_name",
    "last_modified",
    "last_transaction_rid",
    "schema_branch",
    "profiled_at",
    "build_timestamp",
    "total_datasets_profiled",
]


@dataclass
class JobResult:
    """``status`` is ``written`` or ``aborted``; an aborted job leaves its output as it was."""

    status: str
    version: int | None = None
    profiled: int = 0
    failures: list[dict[str, str]] = field(default_factory=list)


def union_profiles(profiles: list[DataFrame]) -> DataFrame:
    """Profiles under one another by column name; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), profiles)


def attach_metadata(profile: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """Name, last change and last transaction of the dataset; nulls where nothing is known."""
    extra = ["dataset_name", "last_modified", "last_transaction_rid"]
    if metadata is None:
        return profile.select("*", *[tag(None).alias(name) for name in extra])
    known = metadata.select("source_rid", "schema_branch", *extra)
    return profile.join(known, ["source_rid", "schema_branch"], "left")


def profile_and_tag(
    df: DataFrame,
    ref: DatasetRef,
    mode: str,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """A profile with source tags, profiling mode, branch and dataset metadata."""
    return attach_metadata(_tagged(df, ref, mode), metadata)


def _tagged(df: DataFrame, ref: DatasetRef, mode: str) -> DataFrame:
    profile = profile_dataframe(df, ref.rid, ref.path)
    return profile.select(
        "*", tag(mode).alias("profiling_mode"), tag(ref.branch).alias("schema_branch")
    )


@dataclass(frozen=True)
class RunOptions:
    """How the datasets of a job are worked off.

    ``threads`` datasets are profiled side by side. ``ledger`` names a run in the shared folder: a
    dataset that an earlier attempt of the run has staged is taken as it is, so an attempt after a
    stop or a failure reads only the rest; a new run needs a new name. ``limit_seconds`` cancels the
    Spark jobs of a dataset that takes longer, which counts as a failure of that dataset alone.
    """

    threads: int = 4
    ledger: str | None = None
    limit_seconds: float | None = None


@contextmanager
def _limited(spark: SparkSession, seconds: float | None) -> Iterator[Event]:
    """Jobs that this thread starts are cancelled when the time is over; the event then is set."""
    over = Event()
    if seconds is None:
        yield over
        return
    context, tag_name = spark.sparkContext, f"dataset-{uuid.uuid4().hex}"

    def cancel() -> None:
        over.set()
        # Again and again: a job may be between two of its stages or not have started yet.
        while not done.wait(0.2):
            context.cancelJobsWithTag(tag_name)

    done, timer = Event(), Timer(seconds, cancel)
    context.addJobTag(tag_name)
    timer.start()
    try:
        yield over
    finally:
        done.set()
        timer.cancel()
        context.removeJobTag(tag_name)


def _stage(
    spark: SparkSession, catalog: Catalog, ref: DatasetRef, mode: str, folder: str, options: RunOptions
) -> str | None:
    """Write one dataset's profile; returns the error text, or None when it went well."""
    files, mark = SharedFiles(spark), f"{folder}.done"
    if options.ledger is not None and files.exists(mark):
        return None
    with _limited(spark, options.limit_seconds) as over:
        try:
            rows = _tagged(catalog.read(ref), ref, mode).coalesce(1)
            rows.write.mode("overwrite").parquet(folder)
        except Exception as error:  # any dataset may fail in any way; the others go on
            return f"took more than {options.limit_seconds} s" if over.is_set() else str(error)
    if options.ledger is not None:
        files.write_text(mark, ref.rid)
    return None


def _staging(ledger: str | None, run: str, mode: str, refs: list[DatasetRef]) -> list[str]:
    """A folder per entry; with a ledger it depends on the entry only, wherever it stands in the list."""
    if ledger is None:
        return [f"{run}/dataset={i}" for i in range(len(refs))]
    times: Counter = Counter()
    folders = []
    for ref in refs:
        entry = (mode, ref.rid, ref.path, ref.branch)
        digest = hashlib.sha256(repr((*entry, times[entry])).encode()).hexdigest()[:32]
        times[entry] += 1
        folders.append(f"{run}/dataset={digest}")
    return folders


def profile_all(
    spark: SparkSession,
    refs: list[DatasetRef],
    catalog: Catalog,
    mode: str,
    options: RunOptions = RunOptions(),
) -> tuple[DataFrame | None, int, list[dict[str, str]]]:
    """(profiles of all readable datasets, how many were read, failures)."""
    if not refs:
        return None, 0, []
    run = scratch(spark, "profiles") if options.ledger is None else f"{shared_root(spark)}/tidegauge/runs/{options.ledger}"
    folders = _staging(options.ledger, run, mode, refs)

    def stage(entry: tuple[DatasetRef, str]) -> str | None:
        return _stage(spark, catalog, entry[0], mode, entry[1], options)

    with ThreadPoolExecutor(max_workers=max(1, min(options.threads, len(refs)))) as pool:
        errors = list(pool.map(stage, zip(refs, folders)))
    good = [f for f, error in zip(folders, errors) if error is None]
    failures = [
        {"rid": ref.rid, "path": ref.path, "error": error}
        for ref, error in zip(refs, errors)
        if error is not None
    ]
    if not good:
        return None, 0, failures
    return spark.read.schema(_STAGED_SCHEMA).parquet(*good), len(good), failures


def _publish(
    profiles: DataFrame | None,
    profiled: int,
    failures: list[dict[str, str]],
    output: VersionedTable,
    columns: list[str],
    metadata: DataFrame | None,
    failure_output: VersionedTable | None,
) -> JobResult:
    spark = output.spark
    if failure_output is not None:
        failure_output.publish(spark.createDataFrame(failures, FAILURE_SCHEMA))
    if profiles is None:
        return JobResult("aborted", failures=failures)
    built = _built(profiles, profiled, failures, columns, metadata)
    return JobResult("written", output.publish(built.coalesce(1)), profiled, failures)


def _built(
    profiles: DataFrame,
    profiled: int,
    failures: list[dict[str, str]],
    columns: list[str],
    metadata: DataFrame | None,
) -> DataFrame:
    return (
        attach_metadata(profiles, metadata)
        .withColumn("build_timestamp", F.current_timestamp())
        .withColumn("total_datasets_profiled", F.lit(profiled))
        .withColumn("total_datasets_failed", F.lit(len(failures)))
        .select(*columns)
    )


def run_registry_job(
    registry: DataFrame,
    catalog: Catalog,
    output: VersionedTable,
    failure_output: VersionedTable | None = None,
    options: RunOptions = RunOptions(),
) -> JobResult:
    """Profile every dataset a registry lists, in the narrow schema with both totals.

    With a ledger an attempt that reads all datasets publishes what the first could not.
    """
    found = profile_all(output.spark, registry_refs(registry), catalog, "registry", options)
    return _publish(*found, output, NARROW_COLUMNS, None, failure_output)


def run_governed_job(
    config: GovernedConfig,
    catalog: Catalog,
    output: VersionedTable,
    metadata: DataFrame | None = None,
    failure_output: VersionedTable | None = None,
    options: RunOptions = RunOptions(),
) -> JobResult:
    """Profile the governed list of a config, in the wide schema."""
    refs = [DatasetRef(r.rid, r.path, DEFAULT_BRANCH) for r in config.governed]
    found = profile_all(output.spark, refs, catalog, "governed", options)
    return _publish(*found, output, WIDE_COLUMNS, metadata, failure_output)


def run_adhoc_job(
    control: DataFrame,
    catalog: Catalog,
    output: VersionedTable,
    metadata: DataFrame | None = None,
    failure_output: VersionedTable | None = None,
    options: RunOptions = RunOptions(),
) -> JobResult:
    """Profile the enabled datasets of a control table, in the wide schema."""
    found = profile_all(output.spark, control_refs(control), catalog, "ad_hoc", options)
    return _publish(*found, output, WIDE_COLUMNS, metadata, failure_output)


def _shared_output(
    config: GovernedConfig,
    catalog: Catalog,
    output: VersionedTable,
    metadata: DataFrame | None,
) -> dict[str, JobResult]:
    spark = output.spark
    governed = [DatasetRef(r.rid, r.path, DEFAULT_BRANCH) for r in config.governed]
    adhoc = control_refs(catalog.dataframe(config.adhoc_control_rid))
    found = {
        "governed": profile_all(spark, governed, catalog, "governed"),
        "ad_hoc": profile_all(spark, adhoc, catalog, "ad_hoc"),
    }
    built = [
        _built(profiles, profiled, failures, WIDE_COLUMNS, metadata)
        for profiles, profiled, failures in found.values()
        if profiles is not None
    ]
    version = output.publish(union_profiles(built).coalesce(1)) if built else None
    return {
        mode: JobResult("aborted", failures=failures)
        if profiles is None
        else JobResult("written", version, profiled, failures)
        for mode, (profiles, profiled, failures) in found.items()
    }


def run_configured_jobs(
    config: GovernedConfig,
    catalog: Catalog,
    outputs: dict[str, VersionedTable],
    metadata: DataFrame | None = None,
) -> dict[str, JobResult]:
    """The governed job if datasets are listed, the ad-hoc job if a control table is named.

    Where both write to one output it gets the rows of both, in one version.
    """
    results = {}
    if config.governed and config.has_adhoc and config.adhoc_output_rid == config.output_rid:
        return _shared_output(config, catalog, outputs[config.output_rid], metadata)
    if config.governed:
        output = outputs[config.output_rid]
        results["governed"] = run_governed_job(config, catalog, output, metadata)
    if config.has_adhoc:
        control = catalog.dataframe(config.adhoc_control_rid)
        output = outputs[config.adhoc_output_rid]
        results["ad_hoc"] = run_adhoc_job(control, catalog, output, metadata)
    return results
