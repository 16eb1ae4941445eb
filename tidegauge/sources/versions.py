"""Versioned Parquet output: every publish is a new folder, made visible by its marker file.

Readers take the highest version that has a marker, so a write that fails or is aborted leaves the
last version in place. A table may be split by an integer slice that depends on its keys only; an
update then rewrites the slices it touches and takes the folders of all others over unchanged.

One writer per table at a time. Where a catalog with row-level MERGE is at hand, use that instead
(``plans.tables.merge_into``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.sources.files import SharedFiles

#: The kind of a change row, and the kind that leaves all earlier rows as they are.
CHANGE_TYPE, INSERT = "_change_type", "insert"

_MARKER = "_published.json"
_SLICE = "slice_id"
_WHOLE = "all"
_CHANGES = "changes"

# What Spark names the folder of a null partition value.
_NULL_SLICE = "__HIVE_DEFAULT_PARTITION__"


def _slice_key(number: int | None) -> str:
    """The name of a slice in folders and markers; null is a slice of its own."""
    return _NULL_SLICE if number is None else str(number)


@dataclass(frozen=True)
class Version:
    number: int
    folders: dict[str, str]
    schema: T.StructType
    batches: dict[str, int]
    logic: str | None
    changes: str | None = None
    rewrites: bool = False


class VersionedTable:
    """``slice_by`` is a bigint expression over key columns, or None for an unsliced table.

    With ``track_changes`` keyed writes also store the change rows of their commit, which readers of
    the changes then take as they are.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        slice_by: Column | None = None,
        track_changes: bool = False,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.slice_by = slice_by
        self.track_changes = track_changes
        self.files = SharedFiles(spark)

    # -- reading ---------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return [int(n[2:]) for n in self.files.children(self.path) if n.startswith("v=")]

    def _marker(self, number: int) -> str:
        return f"{self.path}/v={number:06d}/{_MARKER}"

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        return sorted(n for n in self._numbers() if self.files.exists(self._marker(n)))

    def latest(self) -> int | None:
        """The number of the current version, or None before the first publish."""
        newest_first = sorted(self._numbers(), reverse=True)
        return next((n for n in newest_first if self.files.exists(self._marker(n))), None)

    def version(self, number: int | None = None) -> Version | None:
        chosen = self.latest() if number is None else number
        if chosen is None:
            return None
        if not self.files.exists(self._marker(chosen)):
            raise LookupError(f"{self.path} has no version {chosen}")
        m = json.loads(self.files.read_text(self._marker(chosen)))
        schema = T.StructType.fromJson(m["schema"])
        stored = m.get("changes"), m.get("rewrites", False)
        return Version(chosen, m["folders"], schema, m["batches"], m["logic"], *stored)

    def read(
        self, number: int | None = None, slices: list[int | None] | None = None
    ) -> DataFrame:
        """The current version, or a given one, whole or by slices."""
        v = self.version(number)
        if v is None:
            raise LookupError(f"{self.path} has no published version")
        wanted = v.folders if slices is None else {
            k: f for k, f in v.folders.items() if k in {_slice_key(s) for s in slices}
        }
        return self._load(v.schema, wanted)

    def _load(self, schema: T.StructType, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{f}" for f in folders.values()]
        return self.spark.read.schema(schema).parquet(*paths)

    def previous(self) -> DataFrame | None:
        """What the output held before the current version; None before the second publish."""
        published = self.versions()
        return self.read(published[-2]) if len(published) > 1 else None

    def changed_folders(self, older: int, newer: int) -> tuple[DataFrame, DataFrame]:
        """Both versions without the slices whose folder they share (those cannot differ)."""
        a, b = self.version(older), self.version(newer)
        shared = set(a.folders.values()) & set(b.folders.values())
        return (
            self._load(a.schema, {k: f for k, f in a.folders.items() if f not in shared}),
            self._load(b.schema, {k: f for k, f in b.folders.items() if f not in shared}),
        )

    def stored_changes(self, number: int) -> DataFrame | None:
        """The change rows written with a version; None where a commit stored none."""
        v = self.version(number)
        if v.changes is None:
            return None
        schema = T.StructType([*v.schema.fields, T.StructField(CHANGE_TYPE, T.StringType())])
        if not self.files.exists(f"{self.path}/{v.changes}"):
            return self.spark.createDataFrame([], schema)  # nothing changed
        return self.spark.read.schema(schema).parquet(f"{self.path}/{v.changes}")

    def batch_of(self, query: str) -> int:
        """The last micro-batch a streaming query has published here; -1 before the first."""
        v = self.version()
        return -1 if v is None else v.batches.get(query, -1)

    # -- writing ---------------------------------------------------------------------------

    def slices_of(self, df: DataFrame) -> list[int | None]:
        """The slices a DataFrame touches, the null one last: at most one number per slice comes to
        the driver."""
        found = [r[0] for r in df.select(self.slice_by.cast("bigint")).distinct().collect()]
        return sorted(found, key=lambda s: (s is None, s or 0))

    def publish(
        self,
        df: DataFrame,
        replace: list[int | None] | None = None,
        batches: dict[str, int] | None = None,
        logic: str | None = None,
    ) -> int:
        """Write ``df`` as the next version and make it current.

        With ``replace`` only those slices are rewritten and all others are kept. Where ``df`` has a
        column ``_change_type``, rows with a type are the commit's change rows, written in the same
        job into a folder of their own; only rows without one belong to the table.
        """
        last = self.version()
        number = max(self._numbers(), default=0) + 1
        name = f"v={number:06d}"
        target = f"{self.path}/{name}"
        with_changes = CHANGE_TYPE in df.columns
        rewrites = False
        place = F.lit(_WHOLE) if self.slice_by is None else self.slice_by.cast("bigint")
        if with_changes:
            is_change = F.col(CHANGE_TYPE).isNotNull()
            place = F.when(is_change, F.lit(_CHANGES)).otherwise(place.cast("string"))
        if self.slice_by is None and not with_changes:
            df.write.mode("overwrite").parquet(target)
            folders = {_WHOLE: name}
        else:
            # The hint lets the adaptive planner split large slices and merge small ones, so a
            # hot slice does not end in one task.
            sliced = df.withColumn(_SLICE, place).hint("rebalance", _SLICE)
            sliced.write.mode("overwrite").partitionBy(_SLICE).parquet(target)
            written = [n for n in self.files.children(target) if n.startswith(f"{_SLICE}=")]
            folders = {n.split("=", 1)[1]: f"{name}/{n}" for n in written}
            if folders.pop(_CHANGES, None):
                kinds = self.spark.read.schema(f"{CHANGE_TYPE} string").parquet(f"{target}/{_SLICE}={_CHANGES}")
                rewrites = not kinds.filter(F.col(CHANGE_TYPE) != INSERT).isEmpty()
            if replace is not None and last is not None:
                gone = {_slice_key(s) for s in replace}
                kept = {k: f for k, f in last.folders.items() if k not in gone}
                folders = {**kept, **folders}
        stored = T.StructType([f for f in df.schema if not (with_changes and f.name == CHANGE_TYPE)])
        marker = {
            "folders": folders,
            "schema": json.loads(_nullable(stored).json()),
            "batches": {**(last.batches if last else {}), **(batches or {})},
            "logic": logic if logic is not None or last is None else last.logic,
            "changes": f"{name}/{_SLICE}={_CHANGES}" if with_changes else None,
            "rewrites": rewrites,
        }
        self.files.write_text(f"{target}/{_MARKER}", json.dumps(marker))
        return number

    def expire(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` versions uses."""
        published = self.versions()
        kept = published[-keep:]
        used = {f for n in kept for f in self.version(n).folders.values()}
        dropped = []
        for n in [n for n in self._numbers() if kept and n < kept[0]]:
            name = f"v={n:06d}"
            below = [f"{name}/{c}" for c in self.files.children(f"{self.path}/{name}")]
            in_use = [f for f in used if f == name or f.startswith(f"{name}/")]
            if not in_use:
                below = [name]
            elif name in in_use:
                continue
            for folder in below:
                if folder not in used:
                    self.files.delete(f"{self.path}/{folder}")
                    dropped.append(folder)
        return dropped


def _nullable(schema: T.StructType) -> T.StructType:
    # Parquet reads every column back as nullable.
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
