"""Writes that bring changes into versioned tables, and reads of what changed between versions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import col, cols
from tidegauge.operators.changes import (
    CHANGE_TYPE,
    COMMIT_VERSION,
    DELETE,
    INSERT,
    UPDATE_AFTER,
    apply_changes,
    change_feed,
    follow_changes,
    latest_per_key,
    merge_latest,
    upsert,
)
from tidegauge.sources.versions import VersionedTable

DIGEST = "_digest"


def _touched(table: VersionedTable, rows: DataFrame) -> tuple[DataFrame, list[int] | None]:
    """The part of the table that rows can change: their slices, or everything when unsliced."""
    if table.slice_by is None:
        return table.read(), None
    slices = table.slices_of(rows)
    return table.read(slices=slices), slices


def upsert_table(
    table: VersionedTable,
    updates: DataFrame,
    keys: list[str],
    sequence_by: list[str] | None = None,
    batches: dict[str, int] | None = None,
) -> int:
    """Upsert into the table and publish.

    With ``sequence_by`` duplicates by key are reduced to the highest sequence first, and a stored
    row of a higher sequence stays, one of an equal sequence does not; without it ``updates`` must be unique by key and always win.
    """
    rows = updates if sequence_by is None else latest_per_key(updates, keys, sequence_by)
    if table.latest() is None:
        return table.publish(rows, batches=batches)
    part, slices = _touched(table, updates)
    if sequence_by is None and not table.track_changes:
        merged = upsert(part, rows, keys)
    else:
        merged = merge_latest(part, rows, keys, sequence_by or [], True, images=table.track_changes)
    return table.publish(merged, replace=slices, batches=batches)


def apply_changes_table(
    table: VersionedTable,
    changes: DataFrame,
    keys: list[str],
    sequence_by: list[str],
    delete_when: Column | None = None,
    batches: dict[str, int] | None = None,
) -> int:
    """Apply ordered changes to the table and publish; see ``operators.changes.apply_changes``."""
    if table.latest() is None:
        first = apply_changes(None, changes, keys, sequence_by, delete_when)
        return table.publish(first, batches=batches)
    part, slices = _touched(table, changes)
    merged = apply_changes(part, changes, keys, sequence_by, delete_when, table.track_changes)
    return table.publish(merged, replace=slices, batches=batches)


def recompute(table: VersionedTable, query: Callable[[], DataFrame], logic: str | None = None) -> int:
    """Run a batch query again and overwrite the result: right whatever the arrival order was."""
    return table.publish(query(), logic=logic)


def read_changes(
    table: VersionedTable,
    keys: list[str],
    after: int,
    upto: int | None = None,
    on_change: str = "fail",
) -> DataFrame:
    """Changes of the versions past ``after``, with ``_commit_version``, under a change policy.

    Change rows stored with a commit are read as they are. For other commits the two versions are
    compared; slices that they share are not read.
    """
    published = [v for v in table.versions() if v >= after and (upto is None or v <= upto)]
    if not published or published[0] != after:
        raise LookupError(f"version {after} is not published")
    feeds = []
    for older, newer in zip(published, published[1:]):
        stored = table.stored_changes(newer)
        if stored is None:
            stored = change_feed(*table.changed_folders(older, newer), keys)
        feeds.append(stored.withColumn(COMMIT_VERSION, F.lit(newer)))
    if not feeds:
        now = table.spark.createDataFrame([], table.version(after).schema)
        feeds = [change_feed(now, now, keys).withColumn(COMMIT_VERSION, F.lit(after))]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    names = [n for n in together.columns if n not in (CHANGE_TYPE, COMMIT_VERSION)]
    return follow_changes(together.select(*cols(names), CHANGE_TYPE, COMMIT_VERSION), on_change)


def digests(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and a digest of each row, what a consumer needs to keep to find its way back."""
    whole = F.to_json(F.struct(*cols(rows.columns)), {"ignoreNullFields": "false"})
    return rows.select(*cols(keys), F.sha2(whole, 256).alias(DIGEST))


def resync(table: VersionedTable, state: DataFrame, keys: list[str], upto: int | None = None) -> DataFrame:
    """Changes that bring a consumer whose rows have the digests ``state`` to a version of the table.

    For readers whose version is no longer kept. Rows that the consumer lacks are inserts, rows that
    differ give their image after the change, and keys that are gone are deletes with null values;
    images before a change are not known any more. ``state`` must be unique by key.
    """
    number = table.latest() if upto is None else upto
    now = table.read(number)
    names = now.columns
    held = state.select(*[col(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.col(DIGEST).alias("_held"))
    there = now.select(F.struct(*cols(names)).alias("_row"))
    whole = F.to_json("_row", {"ignoreNullFields": "false"})
    there = there.withColumn("_now", F.sha2(whole, 256))
    match = [F.col("_row")[k].eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)]
    both = there.join(held, reduce(Column.__and__, match), "full_outer")
    kind = (
        F.when(F.col("_held").isNull(), F.lit(INSERT))
        .when(F.col("_now").isNull(), F.lit(DELETE))
        .when(F.col("_now") != F.col("_held"), F.lit(UPDATE_AFTER))
    )
    key = {k: F.coalesce(F.col("_row")[k], F.col(f"_h{i}")) for i, k in enumerate(keys)}
    values = [key.get(n, F.col("_row")[n]).alias(n) for n in names]
    changed = both.withColumn(CHANGE_TYPE, kind).filter(F.col(CHANGE_TYPE).isNotNull())
    return changed.select(*values, CHANGE_TYPE, F.lit(number).alias(COMMIT_VERSION))


class FeedReader:
    """A named reader of a table's changes that remembers how far it has read.

    The position is kept in numbered files below ``path``, the highest one counting, and moves only
    after ``handle`` has returned: a reader that dies in between gets the same changes again.
    """

    def __init__(self, table: VersionedTable, path: str, name: str):
        self.table, self.folder = table, f"{path.rstrip('/')}/{name}"
        self.files = table.files

    def position(self) -> int | None:
        """The last version that was read, or None before the first run."""
        return max((int(n) for n in self.files.children(self.folder) if n.isdigit()), default=None)

    def run(
        self,
        keys: list[str],
        handle: Callable[[DataFrame], object],
        on_change: str = "feed",
        state: Callable[[], DataFrame] | None = None,
    ) -> int | None:
        """Pass all changes since the last run to ``handle``; returns the new position.

        The first run passes the oldest version that is still kept as inserts, then what followed. A
        reader whose version has expired is brought up to date by the ``digests`` of its own rows,
        which ``state`` gives; without it the run raises.
        """
        newest, last = self.table.latest(), self.position()
        if newest is None or newest == last:
            return last
        if last is not None and state is not None and last not in self.table.versions():
            handle(resync(self.table, state(), keys, newest))
            self.files.write_text(f"{self.folder}/{newest:09d}", "")
            return newest
        if last is None:
            last = self.table.versions()[0]
            first = self.table.read(last)
            fresh = change_feed(first.limit(0), first, keys).withColumn(COMMIT_VERSION, F.lit(last))
            feeds = [fresh]
        else:
            feeds = []
        if newest != last:
            feeds.append(read_changes(self.table, keys, last, newest, on_change))
        handle(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds))
        self.files.write_text(f"{self.folder}/{newest:09d}", "")
        return newest


def merge_into(spark: SparkSession, target: str, updates: DataFrame, keys: list[str]) -> None:
    """Row-level MERGE for catalogs that support it; plain Parquet tables refuse."""
    match = reduce(
        lambda a, b: a & b, [F.col(f"{target}.{k}") == F.col(f"updates.{k}") for k in keys]
    )
    merge = updates.alias("updates").mergeInto(target, match)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
