"""Keyed changes: latest row, upsert, ordered change application, change feeds and catch-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import col, cols, row_digest
from tidegauge.sources.versions import CHANGE_TYPE, INSERT

DELETED = "_deleted"
COMMIT_VERSION = "_commit_version"
DELETE = "delete"
UPDATE_BEFORE, UPDATE_AFTER = "update_preimage", "update_postimage"


def latest_per_key(df: DataFrame, keys: list[str], sequence_by: list[str]) -> DataFrame:
    """The row with the highest sequence per key; exact ties go to the greater row digest.

    An aggregate rather than a window: it keeps one row per key and task before the shuffle, so a
    key that holds a third of all changes is no heavier than any other.
    """
    order = F.struct(*cols(sequence_by), row_digest(df))
    rest = [n for n in df.columns if n not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    newest = df.groupBy(*cols(keys)).agg(F.max_by(F.struct(*cols(rest)), order).alias("_newest"))
    return newest.select(*[col(n) if n in keys else F.col("_newest")[n].alias(n) for n in df.columns])


def without_keys_of(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``; null keys count as equal."""
    theirs = other.select(*[col(k).alias(f"_other_{i}") for i, k in enumerate(keys)])
    match = [col(k).eqNullSafe(F.col(f"_other_{i}")) for i, k in enumerate(keys)]
    return rows.join(theirs, reduce(Column.__and__, match), "left_anti")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` put in by key. ``updates`` must be unique by key."""
    kept = without_keys_of(target, updates, keys)
    return kept.unionByName(updates, allowMissingColumns=True)


def merge_latest(
    target: DataFrame,
    newest: DataFrame,
    keys: list[str],
    sequence_by: list[str],
    ties_to_newest: bool = False,
    images: bool = False,
) -> DataFrame:
    """Per key the row with the higher sequence of two tables that are unique by key.

    One join that reads each side once. Equal sequences go to the greater row digest, so the result
    does not depend on which side a row came from, or to ``newest`` if so asked; null keys count as
    equal. Without ``sequence_by`` the rows of ``newest`` win. Columns that one side lacks are null
    in its rows.

    With ``images`` the same join also gives what changed in ``target``: rows with a
    ``_change_type`` as in ``change_feed``, beside the rows of the result, where it is null.
    """
    names = list(dict.fromkeys([*target.columns, *newest.columns]))

    def packed(df: DataFrame, side: str) -> DataFrame:
        whole = widened(df, names, newest if df is target else target)
        tie = [] if ties_to_newest else [row_digest(whole)]
        order = F.struct(*cols(sequence_by), *tie, F.lit(0)).alias(f"{side}_order")
        own = [col(k).alias(f"{side}_{i}") for i, k in enumerate(keys)]
        return whole.select(F.struct(*cols(names)).alias(side), order, *own)

    match = reduce(
        Column.__and__,
        [F.col(f"_held_{i}").eqNullSafe(F.col(f"_new_{i}")) for i in range(len(keys))],
    )
    both = packed(target, "_held").join(packed(newest, "_new"), match, "full_outer")
    held, new = F.col("_held_order"), F.col("_new_order")
    ahead = held > new if ties_to_newest or not sequence_by else held >= new
    stays = F.col("_held").isNotNull() & (F.col("_new").isNull() | ahead)
    chosen = F.when(stays, F.col("_held")).otherwise(F.col("_new"))
    if not images:
        return both.select(chosen.alias("row")).select("row.*")
    rows = F.when(stays, F.array(_image("_held", None))).otherwise(
        F.concat(F.array(_image("_new", None)), _images_of("_held", "_new", names, keys))
    )
    return both.select(F.explode(rows).alias("c")).select("c.row.*", F.col("c.kind").alias(CHANGE_TYPE))


def _image(side: str, kind: str | None) -> Column:
    return F.struct(F.col(side).alias("row"), F.lit(kind).cast("string").alias("kind"))


def _images_of(old: str, new: str, names: list[str], keys: list[str]) -> Column:
    """The change rows between two row structs of one key, either of which may be null."""
    differs = reduce(
        Column.__or__,
        [~F.col(old)[n].eqNullSafe(F.col(new)[n]) for n in names if n not in keys],
        F.lit(False),
    )
    both = F.array(_image(old, UPDATE_BEFORE), _image(new, UPDATE_AFTER))
    return (
        F.when(F.col(old).isNull(), F.array(_image(new, INSERT)))
        .when(F.col(new).isNull(), F.array(_image(old, DELETE)))
        .when(differs, both)
        .otherwise(F.slice(both, 1, 0))
    )


def widened(df: DataFrame, names: list[str], other: DataFrame) -> DataFrame:
    """``df`` with the columns ``names``; those it lacks are null, in the type ``other`` has."""
    lacking = {n: F.lit(None).cast(other.schema[n].dataType) for n in names if n not in df.columns}
    return df.withColumns(lacking).select(*cols(names)) if lacking else df.select(*cols(names))


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence_by: list[str],
    delete_when: Column | None = None,
    images: bool = False,
) -> DataFrame:
    """Bring change rows into ``target`` by key and sequence, in any arrival order.

    Deleted keys stay as rows flagged ``_deleted``, so that an older change that comes late cannot
    bring them back; ``live_rows`` hides them. Applying the same changes again changes nothing.

    The target is read once, in one join with the reduced changes.
    """
    flag = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    marked = changes.withColumn(DELETED, flag)
    newest = latest_per_key(marked, keys, sequence_by)
    if target is None:
        return newest
    return merge_latest(target, newest, keys, sequence_by, images=images)


def live_rows(target: DataFrame) -> DataFrame:
    return target.filter(~F.col(DELETED)).drop(DELETED)


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level changes between two snapshots that are unique by key.

    Inserts and deletes give one row; an update gives its image before and after. Columns are those
    of ``after`` and then those that only ``before`` has, null where a side lacks them, with
    ``_change_type`` last.
    """
    names = list(dict.fromkeys([*after.columns, *before.columns]))
    before, after = widened(before, names, after), widened(after, names, before)

    def packed(df: DataFrame, side: str) -> DataFrame:
        row = F.struct(*cols(names)).alias(side)
        return df.select(*[col(k).alias(f"_k{i}_{side}") for i, k in enumerate(keys)], row)

    old, new = packed(before, "old"), packed(after, "new")
    match = reduce(
        lambda a, b: a & b,
        [F.col(f"_k{i}_old").eqNullSafe(F.col(f"_k{i}_new")) for i in range(len(keys))],
    )
    both = old.join(new, match, "full_outer")
    images = _images_of("old", "new", names, keys)
    exploded = both.select(F.explode(images).alias("c"))
    return exploded.select(
        *[F.col("c.row")[n].alias(n) for n in names], F.col("c.kind").alias(CHANGE_TYPE)
    )


class UpstreamChangeError(RuntimeError):
    """An upstream commit held updates or deletes and the reader only takes appends."""


def follow_changes(feed: DataFrame, on_change: str = "fail") -> DataFrame:
    """A feed with ``_commit_version`` under a policy for commits that are not pure appends.

    ``fail`` raises if there is one, ``skip`` leaves the whole commit out, ``feed`` passes all
    rows on with their change type.
    """
    if on_change == "feed":
        return feed
    if on_change not in ("fail", "skip"):
        raise ValueError(f"on_change must be fail, skip or feed, not {on_change!r}")
    not_appends = feed.filter(F.col(CHANGE_TYPE) != INSERT).select(COMMIT_VERSION).distinct()
    if on_change == "fail":
        first = not_appends.agg(F.min(COMMIT_VERSION)).first()[0]
        if first is not None:
            raise UpstreamChangeError(f"commit {first} updates or deletes rows")
        return feed
    # At most one number per commit. As literals they prune whole commits from the plan, and no
    # join puts all rows of a commit into one task.
    skipped = [r[0] for r in not_appends.collect()]
    return feed.filter(~F.col(COMMIT_VERSION).isin(skipped)) if skipped else feed


def missing_rows(bronze: DataFrame, silver: DataFrame, keys: list[str]) -> DataFrame:
    """Bronze rows whose key never reached silver, such as rows dropped as late."""
    return without_keys_of(bronze, silver, keys)


def catch_up(
    bronze: DataFrame, silver: DataFrame, keys: list[str], sequence_by: list[str]
) -> DataFrame:
    """Silver with the missing keys put in, the latest row each."""
    latest = latest_per_key(missing_rows(bronze, silver, keys), keys, sequence_by)
    # No key of these rows is in silver, so nothing has to be replaced there.
    return silver.unionByName(latest.select(*cols(silver.columns)))
