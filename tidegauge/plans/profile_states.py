"""Profiles that are merged from stored states, so that only changed slices are read again.

The folder of a slice never changes once it is published, and neither does its state: counts, moments,
range and lengths per column, and how often each value occurs. A profile of any version merges the
states of its folders; after an upsert only the folders it wrote have none yet.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import quoted
from tidegauge.operators.profile import (
    COLUMNS_PER_SCAN,
    LONG_TEXT_BYTES,
    lane_of,
    rendered_profile,
)
from tidegauge.sources.files import SharedFiles
from tidegauge.sources.versions import VersionedTable

_DONE = "_done.json"
_FOLDER = "_folder"

# What the state of a column in a folder holds; a family fills its part.
_STATE = {
    "row_count": "bigint",
    "filled": "bigint",
    "low": "string",
    "high": "string",
    "mean": "double",
    "spread": "double",
    "min_length": "int",
    "max_length": "int",
    "sum_length": "bigint",
}


def _state_of(field: T.StructField) -> dict[str, str]:
    """The aggregates of a column's state, as SQL."""
    family, kind = lane_of(field.dataType)
    name = quoted(field.name)
    state = {"row_count": "count(1)", "filled": f"count({name})"}
    if family == "numeric":
        value, double = f"CAST({name} AS {kind})", f"CAST({name} AS double)"
        # The sum of squared distances from the mean; it merges without loss of digits.
        spread = f"var_pop({double}) * count({name})"
        return state | {"low": f"min({value})", "high": f"max({value})", "mean": f"avg({double})", "spread": spread}
    state |= {"low": f"min(CAST({name} AS string))", "high": f"max(CAST({name} AS string))"}
    if family == "text":
        length = f"length({name})"
        state |= {"min_length": f"min({length})", "max_length": f"max({length})", "sum_length": f"sum({length})"}
    return state


def _key_of(field: T.StructField) -> str:
    """A text that two values share if and only if they are equal, as SQL."""
    family, kind = lane_of(field.dataType)
    name = quoted(field.name)
    if family == "numeric":
        # Adding zero makes one of the two zeros of floating point.
        plain = f"{name} + CAST(0 AS {kind})" if kind in ("float", "double") else f"CAST({name} AS {kind})"
        return f"CAST({plain} AS string)"
    if family == "text":
        return f"CASE WHEN octet_length({name}) <= {LONG_TEXT_BYTES} THEN {name} ELSE sha2({name}, 256) END"
    if kind == "timestamp":
        return f"CAST(unix_micros({name}) AS string)"
    if family == "scalar":
        return f"CAST({name} AS string)"
    if kind == "binary":
        return f"sha2({name}, 256)"
    return f"CASE WHEN {name} IS NOT NULL THEN sha2(to_json(struct({name} AS v)), 256) END"


class ProfileStates:
    """States of a versioned table's folders, kept below ``path``.

    Each refresh writes a run of its own and marks it when it is whole; a run that died is passed over.
    """

    def __init__(self, table: VersionedTable, path: str):
        self.table, self.path = table, path.rstrip("/")
        self.spark = table.spark
        self.files = SharedFiles(self.spark)

    def _runs(self) -> dict[int, dict]:
        runs = {}
        for name in self.files.children(self.path):
            if name.startswith("run=") and self.files.exists(f"{self.path}/{name}/{_DONE}"):
                runs[int(name[4:])] = json.loads(self.files.read_text(f"{self.path}/{name}/{_DONE}"))
        return runs

    def refresh(self, version: int | None = None) -> list[str]:
        """Read the folders of a version that have no state yet; returns them."""
        v = self.table.version(version)
        if v is None:
            raise LookupError(f"{self.table.path} has no published version")
        schema = v.schema.json()
        known = {f for run in self._runs().values() if run["schema"] == schema for f in run["folders"]}
        missing = sorted(set(v.folders.values()) - known)
        if not missing:
            return []
        for field in v.schema:
            if "collate" in field.dataType.simpleString().lower():
                raise ValueError(f"{field.name} has a collation: its states cannot be merged by text")
        begun = [int(n[4:]) for n in self.files.children(self.path) if n.startswith("run=")]
        number = max(begun, default=0) + 1
        run = f"{self.path}/run={number:06d}"
        place = F.regexp_extract("_metadata.file_path", r"/(v=\d+(?:/slice_id=[^/]+)?)/[^/]*$", 1)
        rows = self.spark.read.schema(v.schema).parquet(*[f"{self.table.path}/{f}" for f in missing])
        rows = rows.withColumn(_FOLDER, place)
        fields = list(enumerate(v.schema))
        parts = [fields[i : i + COLUMNS_PER_SCAN] for i in range(0, len(fields), COLUMNS_PER_SCAN)]
        reduce(DataFrame.unionAll, [self._states(rows, p) for p in parts]).write.parquet(f"{run}/states")
        reduce(DataFrame.unionAll, [self._values(rows, p) for p in parts]).write.parquet(f"{run}/values")
        self.files.write_text(f"{run}/{_DONE}", json.dumps({"folders": missing, "schema": schema}))
        return missing

    @staticmethod
    def _states(rows: DataFrame, fields: list[tuple[int, T.StructField]]) -> DataFrame:
        aggregates, entries = [], []
        for i, field in fields:
            state = _state_of(field)
            aggregates += [F.expr(f"{e} AS {n}_{i}") for n, e in state.items()]
            filled = [f"CAST({f'{n}_{i}' if n in state else 'NULL'} AS {k}) AS {n}" for n, k in _STATE.items()]
            entries.append(f"struct({i} AS position, {', '.join(filled)})")
        wide = rows.groupBy(_FOLDER).agg(*aggregates)
        return wide.selectExpr(_FOLDER, f"explode(array({', '.join(entries)})) AS s").select(_FOLDER, "s.*")

    @staticmethod
    def _values(rows: DataFrame, fields: list[tuple[int, T.StructField]]) -> DataFrame:
        wide = rows.selectExpr(_FOLDER, *[f"{_key_of(f)} AS `{i}`" for i, f in fields])
        long = wide.unpivot([_FOLDER], [str(i) for i, _ in fields], "position", "v").filter("v IS NOT NULL")
        return long.groupBy(_FOLDER, F.col("position").cast("int").alias("position"), "v").agg(
            F.count(F.lit(1)).alias("n")
        )

    def _read(self, kind: str, folders: list[str], schema: str) -> DataFrame:
        """The states of these folders, from the runs that wrote them."""
        used = []
        for number, run in self._runs().items():
            mine = sorted(set(run["folders"]) & set(folders)) if run["schema"] == schema else []
            if mine:
                part = self.spark.read.parquet(f"{self.path}/run={number:06d}/{kind}")
                used.append(part if mine == run["folders"] else part.filter(F.col(_FOLDER).isin(mine)))
        return reduce(DataFrame.unionAll, used).drop(_FOLDER)

    def profile(
        self, version: int | None = None, source_rid: str | None = None, dataset_path: str | None = None
    ) -> DataFrame:
        """The version's profile, as ``profile_dataframe`` gives it, from states only."""
        self.refresh(version)
        v = self.table.version(version)
        folders, schema = list(v.folders.values()), v.schema.json()
        if not folders:
            return rendered_profile(self.spark.createDataFrame([], _RAW), v.schema, source_rid, dataset_path)
        states = self._read("states", folders, schema)
        kinds: dict[str, list[int]] = {}
        for i, field in enumerate(v.schema):
            family, kind = lane_of(field.dataType)
            kinds.setdefault(kind if family == "numeric" else "string", []).append(i)

        def by_kind(expression: str) -> str:
            """The value of the column's own kind, each taken in its own order."""
            each = [
                expression.format(kind=k, here=f"position IN ({', '.join(map(str, members))})")
                for k, members in kinds.items()
            ]
            return f"coalesce({', '.join(each)})"

        low = by_kind("CAST(min(CASE WHEN {here} THEN CAST(low AS {kind}) END) AS string)")
        high = by_kind("CAST(max(CASE WHEN {here} THEN CAST(high AS {kind}) END) AS string)")
        merged = states.groupBy("position").agg(
            F.expr("sum(row_count) AS row_count"),
            F.expr("sum(filled) AS filled"),
            F.expr(f"{low} AS min_value"),
            F.expr(f"{high} AS max_value"),
            F.expr("sum(mean * filled) / sum(CASE WHEN mean IS NOT NULL THEN filled END) AS mean"),
            F.expr("min(min_length) AS min_length"),
            F.expr("max(max_length) AS max_length"),
            F.expr("CAST(sum(sum_length) AS double) / sum(filled) AS avg_length"),
        )
        about = states.join(merged.select("position", F.col("mean").alias("whole")), "position")
        distance = "spread + filled * (mean - whole) * (mean - whole)"
        spread = about.groupBy("position").agg(
            F.expr(f"sqrt(sum({distance}) / sum(CASE WHEN mean IS NOT NULL THEN filled END)) AS stddev_pop")
        )
        counts = self._read("values", folders, schema).groupBy("position", "v").agg(F.sum("n").alias("n"))
        numeric = {k: m for k, m in kinds.items() if k != "string"}
        modes = [
            f"CAST(min(CASE WHEN position IN ({', '.join(map(str, m))}) "
            f"THEN struct(-n AS n, CAST(v AS {k}) AS v) END).v AS string)"
            for k, m in numeric.items()
        ]
        mode = f"coalesce({', '.join(modes)})" if modes else "CAST(NULL AS string)"
        ranked = counts.groupBy("position").agg(
            F.expr("count(1) AS distinct_count"), F.expr(f"{mode} AS numeric_mode")
        )
        raw = merged.join(spread, "position", "left").join(ranked, "position", "left")
        return rendered_profile(raw, v.schema, source_rid, dataset_path)


_RAW = (
    "position int, row_count bigint, filled bigint, distinct_count bigint, min_value string, max_value string, "
    "mean double, stddev_pop double, numeric_mode string, min_length int, max_length int, avg_length double"
)
