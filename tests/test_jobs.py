import json
import time
import uuid
from datetime import datetime

import pytest

from tidegauge.operators.rows import people_over
from tidegauge.plans import profiling
from tidegauge.plans.profiling import (
    METADATA_SCHEMA,
    NARROW_COLUMNS,
    RunOptions,
    WIDE_COLUMNS,
    profile_all,
    profile_and_tag,
    run_adhoc_job,
    run_configured_jobs,
    run_registry_job,
    union_profiles,
)
from tidegauge.session import scratch, shared_root
from tidegauge.sources.datasets import Catalog, DatasetRef, Location
from tidegauge.sources.registry import (
    CONTROL_SCHEMA,
    REGISTRY_SCHEMA,
    build_control_table,
    control_from_folder,
    control_refs,
    list_files,
    read_config,
    registry_refs,
)
from tidegauge.sources.versions import VersionedTable


@pytest.fixture
def catalog(spark, folder):
    spark.range(5).selectExpr("id", "id * 2 AS twice").write.parquet(f"{folder}/good")
    spark.range(3).write.parquet(f"{folder}/dev/good")
    spark.createDataFrame([], "x int").write.parquet(f"{folder}/empty")
    return Catalog(spark, folder)


def table(spark, label):
    return VersionedTable(spark, scratch(spark, label))


def test_row_filter_drops_nulls_and_keeps_the_schema(spark):
    people = spark.createDataFrame([("a", 28), ("b", 29), ("c", None)], "name string, age int")
    assert [tuple(r) for r in people_over(people).collect()] == [("b", 29)]
    assert people_over(people, 99).columns == ["name", "age"]


def test_registry_defaults_and_branches(spark, catalog):
    rows = [("r1", "good", None), ("r2", "good", ""), ("r3", "good", "dev")]
    refs = registry_refs(spark.createDataFrame(rows, REGISTRY_SCHEMA))
    assert [r.branch for r in refs] == ["master", "master", "dev"]
    assert [catalog.read(r).count() for r in refs] == [5, 5, 3]


def test_catalog_entries(spark, catalog, folder):
    catalog.add("csv", Location(f"{folder}/x.csv", "csv", {"header": "true"}))
    with open(f"{folder}/x.csv", "w") as out:
        out.write("a,b\n1,2\n")
    assert catalog.dataframe("csv").columns == ["a", "b"]
    spark.range(2).createOrReplaceTempView("some_view")
    catalog.add_table("view", "some_view", "dev")
    assert catalog.dataframe("view", "dev").count() == 2
    with pytest.raises(LookupError):
        Catalog(spark).dataframe("nothing")


def test_registry_job_isolates_failures(spark, catalog):
    rows = [("a", "good", "master"), ("b", "gone", None), ("c", "empty", None), ("d", "good", "dev")]
    output, failures = table(spark, "out"), table(spark, "failures")
    result = run_registry_job(
        spark.createDataFrame(rows, REGISTRY_SCHEMA), catalog, output, failures
    )
    assert (result.status, result.profiled, len(result.failures)) == ("written", 3, 1)
    profile = output.read()
    assert profile.columns == NARROW_COLUMNS
    found = profile.collect()
    assert sorted((r["source_rid"], r["column_name"]) for r in found) == [
        ("a", "id"), ("a", "twice"), ("d", "id"),
    ]
    assert {(r["total_datasets_profiled"], r["total_datasets_failed"]) for r in found} == {(3, 1)}
    assert all(r["build_timestamp"] and r["profiled_at"] for r in found)
    bad = failures.read().collect()
    assert [(r["rid"], r["path"]) for r in bad] == [("b", "gone")] and bad[0]["error"]


def test_nothing_to_write_leaves_the_output_alone(spark, catalog):
    output = table(spark, "out")
    good = spark.createDataFrame([("a", "good", None)], REGISTRY_SCHEMA)
    assert run_registry_job(good, catalog, output).status == "written"
    failing = spark.createDataFrame([("b", "gone", None)], REGISTRY_SCHEMA)
    for registry in (failing, spark.createDataFrame([], REGISTRY_SCHEMA)):
        assert run_registry_job(registry, catalog, output).status == "aborted"
    assert output.versions() == [1] and output.read().count() == 2


def test_adhoc_job_with_control_table_and_metadata(spark, catalog):
    control = spark.createDataFrame(
        [
            ("a", "good", None, True, None, None, None),
            ("b", "good", "dev", True, None, None, None),
            ("c", "good", None, False, None, None, None),
            ("d", "good", None, None, None, None, None),
        ],
        CONTROL_SCHEMA,
    )
    assert [r.rid for r in control_refs(control)] == ["a", "b"]
    metadata = spark.createDataFrame([("b", "dev", "B", "t", "tx")], METADATA_SCHEMA)
    output = table(spark, "adhoc")
    run_adhoc_job(control, catalog, output, metadata)
    rows = output.read()
    assert rows.columns == WIDE_COLUMNS
    names = {(r["source_rid"], r["schema_branch"]): r["dataset_name"] for r in rows.collect()}
    assert names == {("a", "master"): None, ("b", "dev"): "B"}
    assert {r["profiling_mode"] for r in rows.collect()} == {"ad_hoc"}


def test_control_without_optional_columns(spark):
    bare = spark.createDataFrame([("a", "p")], "rid string, path string")
    assert control_refs(bare) == [DatasetRef("a", "p", "master")]


def test_control_builder_and_folder_scan(spark, catalog, folder):
    rows = [
        {"rid": "a", "path": "p", "branch": "master", "enabled": True, "added_at": datetime.now(),
         "added_by": "me", "notes": None},
        {"rid": "b", "path": "q", "branch": None, "enabled": None, "added_at": None,
         "added_by": None, "notes": None},
    ]
    assert [r["rid"] for r in build_control_table(spark, rows).collect()] == ["a"]
    scanned = control_from_folder(spark, folder)
    assert scanned.columns == CONTROL_SCHEMA.names
    assert sorted(r["path"] for r in scanned.collect()) == ["dev", "empty", "good"]
    plan = list_files(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.splitlines()[0]


def test_configured_jobs(spark, catalog, folder):
    config = {
        "hostname": "h",
        "governed_datasets": [{"rid": "a", "path": "good"}],
        "output_rid": "out",
        "adhoc_control_rid": "control",
    }
    path = f"{folder}/config.json"
    with open(path, "w") as out:
        json.dump(config, out, indent=2)
    read = read_config(spark, path)
    assert read.adhoc_output_rid == "out" and read.has_adhoc
    spark.createDataFrame([("b", "good", "dev")], "rid string, path string, branch string").write.parquet(
        f"{folder}/control"
    )
    catalog.add("control", Location(f"{folder}/control"))
    output = table(spark, "out")
    results = run_configured_jobs(read, catalog, {"out": output})
    assert {k: r.status for k, r in results.items()} == {"governed": "written", "ad_hoc": "written"}
    assert {r["profiling_mode"] for r in output.read().collect()} == {"governed", "ad_hoc"}
    assert output.versions() == [1]


def test_profile_and_tag(spark):
    tagged = profile_and_tag(spark.range(1), DatasetRef("r", "p", "dev"), "governed")
    row = tagged.first()
    assert (row["profiling_mode"], row["schema_branch"], row["dataset_name"]) == ("governed", "dev", None)
    assert dict(tagged.dtypes)["dataset_name"] == "string"


def test_union_of_profiles_fills_missing_columns(spark):
    narrow, wide = spark.range(1).selectExpr("id"), spark.range(1).selectExpr("'x' AS extra", "id")
    found = union_profiles([narrow, wide, narrow]).orderBy("extra").collect()
    assert [r["extra"] for r in found] == [None, None, "x"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch(spark, "x") != scratch(spark, "x")
    assert profiling.scratch(spark, "x").startswith(shared_root(spark))


def test_folder_scan_cuts_the_root_once(spark, folder):
    root = f"{folder}/data"
    spark.range(3).write.parquet(f"{root}/ds1{root}/x")
    spark.range(3).write.parquet(f"{root}/ds2")
    assert sorted(r["path"] for r in control_from_folder(spark, root).collect()) == ["ds1", "ds2"]


class Watched(Catalog):
    """Notes what is read; ids that begin with ``slow`` take a second per row."""

    def __init__(self, spark):
        super().__init__(spark)
        self.read_ids = []

    def read(self, ref):
        self.read_ids.append(ref.rid)
        if ref.rid == "gone":
            raise LookupError("gone")

        def slowly(batches):
            for batch in batches:
                time.sleep(60 if ref.rid.startswith("slow") else 0)
                yield batch

        return self.spark.range(0, 3, 1, 1).mapInArrow(slowly, "id long")


def test_a_run_goes_on_where_it_stopped(spark):
    refs = [DatasetRef(r, r) for r in ("a", "gone", "b", "a")]
    first, second = Watched(spark), Watched(spark)
    run = RunOptions(ledger=uuid.uuid4().hex)
    _, profiled, failures = profile_all(spark, refs, first, "registry", run)
    assert profiled == 3 and [f["rid"] for f in failures] == ["gone"]
    profiles, profiled, _ = profile_all(spark, refs[::-1] + [DatasetRef("c", "c")], second, "registry", run)
    assert sorted(second.read_ids) == ["c", "gone"] and profiled == 4
    assert sorted(r.source_rid for r in profiles.collect()) == ["a", "a", "b", "c"]


def test_a_slow_dataset_is_cancelled_alone(spark):
    refs = [DatasetRef(r, r) for r in ("a", "slow", "b")]
    began = time.time()
    options = RunOptions(limit_seconds=30)
    profiles, profiled, failures = profile_all(spark, refs, Watched(spark), "registry", options)
    assert time.time() - began < 58
    assert failures == [{"rid": "slow", "path": "slow", "error": "took more than 30 s"}]
    assert sorted(r.source_rid for r in profiles.collect()) == ["a", "b"] and profiled == 2
