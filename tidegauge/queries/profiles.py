"""Profile queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.profile import profile_dataframe, value_counts
from tidegauge.operators.rows import select_where
from tidegauge.plans.profiling import (
    METADATA_SCHEMA,
    RunOptions,
    run_adhoc_job,
    run_governed_job,
    run_registry_job,
    union_profiles,
)
from tidegauge.queries.base import Registry, table, table_path
from tidegauge.session import scratch
from tidegauge.sources.datasets import Catalog, DatasetRef, Location
from tidegauge.sources.registry import (
    CONTROL_SCHEMA,
    REGISTRY_SCHEMA,
    GovernedConfig,
    control_from_folder,
    governed_datasets,
)
from tidegauge.sources.versions import VersionedTable

register = Registry()

# The columns of the driver's tables with their Spark types.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
NUMERIC = {"int", "bigint", "double"}

# Means of two-decimal columns fall on exact ties at the profile's six places, where the order of
# a float sum decides; results are compared at four.
MOMENT_DIGITS = 4


def _picked(profile: DataFrame, fields: list[str], *others: str) -> DataFrame:
    moments = ("mean", "stddev_pop", "cv")
    picked = [F.round(f, MOMENT_DIGITS).alias(f) if f in moments else F.col(f) for f in fields]
    return profile.select(*others, *picked)


def _columns(name: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ", 1)) for c in COLUMNS[name].split(", ")]


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(({part}) / CAST({whole} AS DOUBLE), 6) ELSE 0.0 END"


def _rounded(expression: str) -> str:
    return f"round(round({expression}, 6), {MOMENT_DIGITS})"


def _column_sql(name: str, column: str, kind: str) -> dict[str, str]:
    """DuckDB expressions for every profile field of one column."""
    numeric, text = kind in NUMERIC, kind == "string"
    as_double = f"CAST({column} AS DOUBLE)"
    filled = f"count({column})"
    mode = (
        f"(SELECT CAST({column} AS VARCHAR) FROM {name} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} ASC LIMIT 1)"
    )
    return {
        "column_name": f"'{column}'",
        "data_type": f"'{kind}'",
        "row_count": "count(*)",
        "null_count": f"count(*) - {filled}",
        "null_pct": _ratio(f"count(*) - {filled}", "count(*)"),
        "distinct_count": f"count(DISTINCT {column})",
        "uniqueness_ratio": _ratio(f"count(DISTINCT {column})", filled),
        "min_value": f"CAST(min({column}) AS VARCHAR)",
        "max_value": f"CAST(max({column}) AS VARCHAR)",
        "mean": _rounded(f"avg({as_double})") if numeric else "CAST(NULL AS DOUBLE)",
        "stddev_pop": _rounded(f"stddev_pop({as_double})") if numeric else "CAST(NULL AS DOUBLE)",
        "cv": (
            f"CASE WHEN avg({as_double}) <> 0 THEN "
            + _rounded(f"stddev_pop({as_double}) / avg({as_double})")
            + " END"
            if numeric
            else "CAST(NULL AS DOUBLE)"
        ),
        "numeric_mode": mode if numeric else "CAST(NULL AS VARCHAR)",
        "min_length": f"CAST(min(length({column})) AS INTEGER)" if text else "CAST(NULL AS INTEGER)",
        "max_length": f"CAST(max(length({column})) AS INTEGER)" if text else "CAST(NULL AS INTEGER)",
        "avg_length": f"round(avg(length({column})), 4)" if text else "CAST(NULL AS DOUBLE)",
    }


def profile_sql(
    names: list[str],
    fields: list[str],
    keep=lambda column, kind: True,
    table_column: str | None = "table_name",
) -> str:
    """One SELECT per column, UNION ALL."""
    parts = []
    for name in names:
        for column, kind in _columns(name):
            if not keep(column, kind):
                continue
            expressions = _column_sql(name, column, kind)
            chosen = [f"{expressions[f]} AS {f}" for f in fields]
            if table_column:
                chosen.insert(0, f"'{name}' AS {table_column}")
            parts.append(f"SELECT {', '.join(chosen)} FROM {name}")
    return "\nUNION ALL\n".join(parts)


METRICS = list(_column_sql("region", "r_regionkey", "int"))


def _profiles(spark: SparkSession, sf_dir: str, names: list[str], fields: list[str]) -> DataFrame:
    metrics = [f for f in fields if f not in ("column_name", "data_type")]
    each = [
        _picked(
            profile_dataframe(table(spark, sf_dir, n), n, n, metrics=metrics), fields, "dataset_path"
        )
        for n in names
    ]
    return union_profiles(each).withColumnRenamed("dataset_path", "table_name")


@register("profile_lineitem", profile_sql(["lineitem"], METRICS, table_column=None))
def profile_lineitem(spark, sf_dir):
    return _picked(profile_dataframe(table(spark, sf_dir, "lineitem")), METRICS)


_COUNTS = ["column_name", "data_type", "row_count", "null_count", "null_pct"]


@register("profile_counts", profile_sql(["lineitem", "customer"], _COUNTS))
def profile_counts(spark, sf_dir):
    return _profiles(spark, sf_dir, ["lineitem", "customer"], _COUNTS)


_DISTINCT = ["column_name", "distinct_count", "uniqueness_ratio"]


@register("profile_distinct", profile_sql(["lineitem", "customer"], _DISTINCT))
def profile_distinct(spark, sf_dir):
    return _profiles(spark, sf_dir, ["lineitem", "customer"], _DISTINCT)


_NUMERIC_FIELDS = ["column_name", "min_value", "max_value", "mean", "stddev_pop", "cv"]


def _is_numeric(column: str, kind: str) -> bool:
    return kind in NUMERIC


@register("profile_numeric", profile_sql(["lineitem", "orders"], _NUMERIC_FIELDS, _is_numeric))
def profile_numeric(spark, sf_dir):
    found = _profiles(spark, sf_dir, ["lineitem", "orders"], ["data_type", *_NUMERIC_FIELDS])
    return found.filter(F.col("data_type").isin(*sorted(NUMERIC))).drop("data_type")


_MODE_FIELDS = ["column_name", "row_count", "numeric_mode"]


@register("profile_mode", profile_sql(["lineitem", "part"], _MODE_FIELDS))
def profile_mode(spark, sf_dir):
    return _profiles(spark, sf_dir, ["lineitem", "part"], _MODE_FIELDS)


_TEXT_FIELDS = ["column_name", "min_value", "max_value", "min_length", "max_length", "avg_length"]


def _is_text(column: str, kind: str) -> bool:
    return kind == "string"


@register("profile_text", profile_sql(["customer", "documents"], _TEXT_FIELDS, _is_text))
def profile_text(spark, sf_dir):
    found = _profiles(spark, sf_dir, ["customer", "documents"], ["data_type", *_TEXT_FIELDS])
    return found.filter("data_type = 'string'").drop("data_type")


_OTHER_FIELDS = ["column_name", "null_count", "distinct_count", "min_value", "max_value"]


def _is_other(column: str, kind: str) -> bool:
    return kind == "timestamp_ntz"


@register("profile_other", profile_sql(["orders", "lineitem", "events"], _OTHER_FIELDS, _is_other))
def profile_other(spark, sf_dir):
    names = ["orders", "lineitem", "events"]
    found = _profiles(spark, sf_dir, names, ["data_type", *_OTHER_FIELDS])
    return found.filter("data_type = 'timestamp_ntz'").drop("data_type")


@register(
    "profile_nested",
    """
    SELECT 'vec_id' AS column_name, 'bigint' AS data_type, count(*) AS row_count,
           count(*) - count(vec_id) AS null_count, count(DISTINCT vec_id) AS distinct_count
    FROM embeddings
    UNION ALL
    SELECT 'embedding', 'array<float>', count(*), count(*) - count(embedding),
           count(DISTINCT embedding) FROM embeddings
    UNION ALL
    SELECT 'label', 'int', count(*), count(*) - count(label), count(DISTINCT label) FROM embeddings
    """,
)
def profile_nested(spark, sf_dir):
    return profile_dataframe(table(spark, sf_dir, "embeddings")).select(
        "column_name", "data_type", "row_count", "null_count", "distinct_count"
    )


@register(
    "value_frequencies",
    """
    SELECT 'l_linenumber' AS column_name, CAST(l_linenumber AS BIGINT) AS value, count(*) AS n
    FROM lineitem GROUP BY l_linenumber
    UNION ALL
    SELECT 'l_suppkey', l_suppkey, count(*) FROM lineitem GROUP BY l_suppkey
    """,
)
def value_frequencies(spark, sf_dir):
    names = ["l_linenumber", "l_suppkey"]
    rows = table(spark, sf_dir, "lineitem").select(*[F.col(n).cast("bigint") for n in names])
    column = F.get(F.array(*[F.lit(n) for n in names]), F.col("position"))
    return value_counts(rows).select(column.alias("column_name"), F.col("v").alias("value"), "n")


@register(
    "filter_project",
    "SELECT user_id, value FROM events WHERE value > 28",
)
def filter_project(spark, sf_dir):
    return select_where(table(spark, sf_dir, "events"), F.col("value") > 28, ["user_id", "value"])


# -- jobs --------------------------------------------------------------------------------------

MANY = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _catalog(spark: SparkSession, sf_dir: str, names: list[str]) -> Catalog:
    catalog = Catalog(spark)
    for name in names:
        catalog.add(f"id.{name}", Location(table_path(sf_dir, name)))
    return catalog


def _output(spark: SparkSession, label: str) -> VersionedTable:
    return VersionedTable(spark, scratch(spark, label))


@register(
    "profile_many",
    "SELECT *, 8 AS total_datasets_profiled, 1 AS total_datasets_failed FROM ("
    + profile_sql(MANY, METRICS, table_column="dataset_path")
    + ")",
)
def profile_many(spark, sf_dir):
    """Registry job over eight tables; a ninth entry has no data and is recorded as failed."""
    rows = [(f"id.{n}", n, None if n == "region" else "") for n in MANY]
    registry = spark.createDataFrame([*rows, ("id.gone", "gone", "master")], REGISTRY_SCHEMA)
    output = _output(spark, "profile-many")
    run_registry_job(registry, _catalog(spark, sf_dir, MANY), output)
    totals = ["total_datasets_profiled", "total_datasets_failed"]
    return _picked(output.read(), METRICS, "dataset_path", *totals)


_RESUMED = ["nation", "customer", "orders"]


@register(
    "profile_resumed",
    "SELECT *, 3 AS total_datasets_profiled, 0 AS total_datasets_failed FROM ("
    + profile_sql(_RESUMED, METRICS, table_column="dataset_path")
    + ")",
)
def profile_resumed(spark, sf_dir):
    """Two attempts of one run: the second takes from the ledger what the first had staged.

    In the first attempt one table cannot be read, in the second only that one can.
    """
    registry = spark.createDataFrame([(f"id.{n}", n, "") for n in _RESUMED], REGISTRY_SCHEMA)
    output, run = _output(spark, "profile-resumed"), RunOptions(ledger=uuid.uuid4().hex)
    for there in (["nation", "orders"], ["customer"]):
        run_registry_job(registry, _catalog(spark, sf_dir, there), output, options=run)
    totals = ["total_datasets_profiled", "total_datasets_failed"]
    return _picked(output.read(), METRICS, "dataset_path", *totals)


@register(
    "profile_failures",
    """
    SELECT 'id.gone' AS rid, 'gone' AS path, TRUE AS failed, CAST(NULL AS BIGINT) AS row_count
    UNION ALL
    SELECT 'id.orders', 'orders', FALSE, count(*) FROM orders
    """,
)
def profile_failures(spark, sf_dir):
    """The failures table of a registry job, beside the dataset that went well."""
    registry = spark.createDataFrame(
        [("id.orders", "orders", None), ("id.gone", "gone", None)], REGISTRY_SCHEMA
    )
    output, failures = _output(spark, "profiles"), _output(spark, "failures")
    run_registry_job(registry, _catalog(spark, sf_dir, ["orders"]), output, failures)
    failed = failures.read().select("rid", "path", F.col("error").isNotNull().alias("failed"))
    named = output.read().groupBy(
        F.col("source_rid").alias("rid"), F.col("dataset_path").alias("path")
    )
    good = named.agg(F.max("row_count").alias("row_count")).withColumn("failed", F.lit(False))
    return union_profiles([failed, good])


@register(
    "profile_aborted",
    """
    SELECT 'written' AS status, 1 AS latest, count(*) AS row_count, TRUE AS clocked FROM orders
    UNION ALL
    SELECT 'aborted', 1, count(*), TRUE FROM orders
    """,
)
def profile_aborted(spark, sf_dir):
    """A job, then one that can read nothing: it leaves the output as it was. Clocks are set."""
    output = _output(spark, "profiles")
    found = []
    for name in ("orders", "gone"):
        registry = spark.createDataFrame([(f"id.{name}", name, None)], REGISTRY_SCHEMA)
        result = run_registry_job(registry, _catalog(spark, sf_dir, ["orders"]), output)
        clocks = F.col("profiled_at").isNotNull() & F.col("build_timestamp").isNotNull()
        found.append(
            output.read().agg(
                F.lit(result.status).alias("status"),
                F.lit(output.latest()).alias("latest"),
                F.max("row_count").alias("row_count"),
                F.every(clocks).alias("clocked"),
            )
        )
    return found[0].unionAll(found[1])


@register(
    "profile_odd_names",
    """
    SELECT 'n.name' AS column_name, count(DISTINCT n_name) AS distinct_count FROM nation
    UNION ALL SELECT 'the `key`', count(DISTINCT n_nationkey) FROM nation
    UNION ALL SELECT 'a region', count(DISTINCT n_regionkey) FROM nation
    """,
)
def profile_odd_names(spark, sf_dir):
    """Names with dots, spaces and backticks; a table without rows adds no profile."""
    nation = table(spark, sf_dir, "nation")
    odd = nation.toDF("the `key`", "n.name", "a region")
    metrics = ["distinct_count"]
    profiles = [profile_dataframe(d, metrics=metrics) for d in (odd, odd.limit(0))]
    return union_profiles(profiles).select("column_name", "distinct_count")


@register(
    "profile_governed",
    profile_sql(["customer", "orders"], METRICS, table_column="dataset_path").replace(
        "AS column_name", "AS column_name, 'governed' AS profiling_mode, 'master' AS schema_branch"
    ),
)
def profile_governed(spark, sf_dir):
    """Governed job; the list comes from a JSON config."""
    names = ["customer", "orders"]
    config_path = scratch(spark, "config")
    entries = ", ".join(f"named_struct('rid', 'id.{n}', 'path', '{n}')" for n in names)
    spark.sql(f"SELECT array({entries}) AS governed_datasets, 'out' AS output_rid").coalesce(
        1
    ).write.json(config_path)
    listed = [DatasetRef(*r) for r in governed_datasets(spark, config_path).collect()]
    output = _output(spark, "governed")
    config = GovernedConfig(listed, "out", None, "out")
    run_governed_job(config, _catalog(spark, sf_dir, names), output)
    tags = ["dataset_path", "profiling_mode", "schema_branch"]
    return _picked(output.read(), METRICS, *tags)


@register(
    "profile_enriched",
    "SELECT p.*, m.dataset_name, m.last_modified, m.last_transaction_rid FROM ("
    + profile_sql(["part", "orders", "supplier"], METRICS, table_column="dataset_path")
    + """) p LEFT JOIN (VALUES
        ('part', 'Parts', '2024-01-01', 'tx-1'),
        ('orders', 'Orders', CAST(NULL AS VARCHAR), 'tx-2')
    ) m(dataset_path, dataset_name, last_modified, last_transaction_rid)
    ON p.dataset_path = m.dataset_path""",
)
def profile_enriched(spark, sf_dir):
    """Ad-hoc job: control table with a disabled row, dataset metadata joined on."""
    names = ["part", "orders", "supplier", "region"]
    control = spark.createDataFrame(
        [(f"id.{n}", n, None, n != "region", None, None, None) for n in names], CONTROL_SCHEMA
    )
    metadata = spark.createDataFrame(
        [
            ("id.part", "master", "Parts", "2024-01-01", "tx-1"),
            ("id.orders", "master", "Orders", None, "tx-2"),
            ("id.supplier", "other", "Suppliers", None, "tx-3"),
        ],
        METADATA_SCHEMA,
    RunOptions,
    )
    output = _output(spark, "adhoc")
    run_adhoc_job(control, _catalog(spark, sf_dir, names), output, metadata)
    extra = ["dataset_path", "dataset_name", "last_modified", "last_transaction_rid"]
    return _picked(output.read(), METRICS, *extra)


_FOLDER_FIELDS = ["column_name", "data_type", "row_count", "null_count", "distinct_count"]


@register("profile_folder", profile_sql(sorted(COLUMNS), _FOLDER_FIELDS, table_column="dataset"))
def profile_folder(spark, sf_dir):
    """Ad-hoc job over every dataset a folder scan finds."""
    control = control_from_folder(spark, sf_dir)
    output = _output(spark, "folder")
    run_adhoc_job(control, Catalog(spark, sf_dir), output)
    name = F.regexp_replace("dataset_path", r"\.parquet$", "")
    return output.read().select(name.alias("dataset"), *_FOLDER_FIELDS)
