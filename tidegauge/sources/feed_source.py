"""The stored changes of a versioned table as a stream.

Offsets are versions, partitions are the change files of a commit. A commit becomes visible with its
marker, so a write that died is never read; a checkpoint keeps the version that was read last. The
policy for commits that update or delete rows looks at markers only, no data is read to decide.

Tables are opened through ``pyarrow.fs``, so their store must be one that it knows.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidegauge.sources.versions import CHANGE_TYPE, VersionedTable

COMMIT_VERSION = "_commit_version"
_MARKER = "_published.json"
_FORMAT = "versioned_changes"

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ChangesLostError(LookupError):
    """Changes between the reader's version and the newest one are no longer kept."""


class RowsChangedError(RuntimeError):
    """A commit updates or deletes rows and the reader only takes appends."""


class ChangeFile(InputPartition):
    def __init__(self, path: str, version: int):
        self.path, self.version = path, version


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = path.replace("file:", "file://", 1)
    return fs.FileSystem.from_uri(path)


class ChangeStreamReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.fields = schema.json()
        self.path = options["path"].rstrip("/")
        self.start = int(options["startingversion"])
        self.on_change = options.get("onchange", "fail")
        self.most = int(options.get("maxversionspertrigger", 0))
        self.last = self.start

    def _numbers(self) -> list[int]:
        """Published versions, oldest first."""
        store, root = _opened(self.path)
        names = [i.base_name for i in store.get_file_info(fs.FileSelector(root)) if i.base_name.startswith("v=")]
        markers = store.get_file_info([f"{root}/{n}/{_MARKER}" for n in names])
        return sorted(int(n[2:]) for n, m in zip(names, markers) if m.type == fs.FileType.File)

    def initialOffset(self) -> dict:
        return {"version": self.start}

    def latestOffset(self) -> dict:
        return {"version": max(self._numbers(), default=self.start)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start["version"] >= end["version"]:
            return []
        store, root = _opened(self.path)
        published = self._numbers()
        if start["version"] not in published:
            raise ChangesLostError(f"version {start['version']} is not kept any more")
        found: list[InputPartition] = []
        for number in (n for n in published if start["version"] < n <= end["version"]):
            with store.open_input_stream(f"{root}/v={number:06d}/{_MARKER}") as marker:
                told = json.loads(marker.read())
            if told.get("changes") is None:
                raise ChangesLostError(f"version {number} stored no changes")
            if told["rewrites"] and self.on_change == "fail":
                raise RowsChangedError(f"commit {number} updates or deletes rows")
            if told["rewrites"] and self.on_change == "skip":
                continue
            folder = fs.FileSelector(f"{root}/{told['changes']}", allow_not_found=True)
            files = [i.path for i in store.get_file_info(folder) if i.base_name.endswith(".parquet")]
            found += [ChangeFile(p, number) for p in sorted(files)]
        return found

    def read(self, partition: ChangeFile) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(T.StructType.fromJson(json.loads(self.fields)))
        store, _ = _opened(self.path)
        with store.open_input_file(partition.path) as file:
            data = pq.ParquetFile(file)
            there = [n for n in wanted.names if n in data.schema_arrow.names]
            for batch in data.iter_batches(batch_size=10_000, columns=there):
                columns = []
                for field in wanted:
                    if field.name == COMMIT_VERSION:
                        columns.append(pa.array([partition.version] * batch.num_rows, field.type))
                    elif field.name in there:
                        columns.append(batch.column(field.name).cast(field.type))
                    else:  # a column that came later
                        columns.append(pa.nulls(batch.num_rows, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return _FORMAT

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["fields"]))

    def streamReader(self, schema: T.StructType) -> ChangeStreamReader:
        return ChangeStreamReader(schema, dict(self.options))


def stream_changes(table: VersionedTable, after: int, on_change: str = "fail") -> DataFrame:
    """The change rows of all versions past ``after`` as a stream, with ``_commit_version``.

    The table must have been written with ``track_changes``. A query goes on from its checkpoint;
    ``after`` counts for the first run only. Commits that update or delete rows stop the stream
    (``fail``), are left out as a whole (``skip``) or are passed on (``feed``). Columns are those of
    the newest version, null in older changes. A version that is no longer kept stops the stream.
    """
    if on_change not in ("fail", "skip", "feed"):
        raise ValueError(f"on_change must be fail, skip or feed, not {on_change!r}")
    spark = table.spark
    spark.dataSource.register(ChangeSource)
    added = [T.StructField(CHANGE_TYPE, T.StringType()), T.StructField(COMMIT_VERSION, T.LongType())]
    fields = T.StructType([*table.version().schema.fields, *added]).json()
    reader = spark.readStream.format(_FORMAT).option("path", table.path).option("fields", fields)
    return reader.option("startingVersion", after).option("onChange", on_change).load()
