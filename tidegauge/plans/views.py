"""Views by group that are kept up to date from the changes of their source.

A refresh reads the change rows since the last one and the groups they fall into, nothing else. Counts
and sums take the signed difference of the images before and after; a least or greatest value is
looked up in the source again only for groups that lost a row at that end.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import cols, quoted
from tidegauge.operators.changes import CHANGE_TYPE, INSERT, UPDATE_AFTER, without_keys_of
from tidegauge.plans.tables import read_changes
from tidegauge.session import scratch
from tidegauge.sources.versions import VersionedTable

COUNT = "n"
_SOURCE = "source"


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Equality of all keys between two aliased tables; null keys count as equal."""
    sides = [[F.col(f"{s}.{quoted(k)}") for k in keys] for s in (left, right)]
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in zip(*sides)])


@dataclass
class GroupView:
    """Rows per group of ``source`` with their number ``n``, sums and least and greatest values.

    ``sums`` and ``ranges`` map names to expressions over source rows; a range gives ``<name>_min``
    and ``<name>_max``. Sums must be of integers or decimals, which add up the same in any order.
    Rows for which ``where`` does not hold are not in the view. Groups without rows are left out.
    """

    store: VersionedTable
    source: VersionedTable
    source_keys: list[str]
    groups: list[str]
    sums: dict[str, Column] = field(default_factory=dict)
    ranges: dict[str, Column] = field(default_factory=dict)
    where: Column | None = None

    def _rows(self, df: DataFrame) -> DataFrame:
        """Group columns, summed and ranged values of the rows that are in the view."""
        live = df if self.where is None else df.filter(self.where)
        kind = [F.col(CHANGE_TYPE)] if CHANGE_TYPE in df.columns else []
        sums = [e.alias(f"_sum_{n}") for n, e in self.sums.items()]
        ranges = [e.alias(f"_range_{n}") for n, e in self.ranges.items()]
        rows = live.select(*cols(self.groups), *sums, *ranges, *kind)
        for name in self.sums:
            if isinstance(rows.schema[f"_sum_{name}"].dataType, (T.FloatType, T.DoubleType)):
                raise ValueError(f"sum {name} is of floating point; cast it to a decimal")
        return rows

    def _range_aggregates(self, rows: str = "true") -> list[Column]:
        out = []
        for name in self.ranges:
            value = F.when(F.expr(rows), F.col(f"_range_{name}"))
            out += [F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max")]
        return out

    def computed(self, df: DataFrame) -> DataFrame:
        """The view of ``df`` from all its rows."""
        sums = [F.sum(F.coalesce(f"_sum_{n}", F.lit(0))).alias(n) for n in self.sums]
        grouped = self._rows(df).groupBy(*cols(self.groups))
        return grouped.agg(F.count(F.lit(1)).alias(COUNT), *sums, *self._range_aggregates())

    def read(self) -> DataFrame:
        return self.store.read()

    def position(self) -> int | None:
        """The source version that the view shows, stored with the view itself."""
        seen = self.store.batch_of(_SOURCE)
        return None if seen < 0 else seen

    def refresh(self) -> int:
        """Bring the view up to the newest source version; returns the view's version.

        A view whose place in the changes is no longer kept is computed from all rows.
        """
        newest, at = self.source.latest(), self.position()
        if at == newest and at is not None:
            return self.store.latest()
        place = {_SOURCE: newest}
        if at is None or at not in self.source.versions():
            return self.store.publish(self.computed(self.source.read(newest)), batches=place)
        feed = read_changes(self.source, self.source_keys, at, newest, on_change="feed")
        changed, slices = self._changed_groups(feed, newest)
        before = self.store.read(slices=slices)
        kept = without_keys_of(before, changed, self.groups)
        after = changed.filter(F.col(COUNT) > 0).select(*cols(before.columns))
        return self.store.publish(kept.unionByName(after), replace=slices, batches=place)

    def _changed_groups(self, feed: DataFrame, newest: int) -> tuple[DataFrame, list[int | None] | None]:
        """The new rows of all groups with a change, and the view's slices they fall into."""
        spark, folder = self.source.spark, scratch(self.source.spark, "view")
        comes = F.col(CHANGE_TYPE).isin(INSERT, UPDATE_AFTER)
        sign = F.when(comes, 1).otherwise(-1)
        sums = [F.sum(F.coalesce(sign * F.col(f"_sum_{n}"), F.lit(0))).alias(n) for n in self.sums]
        gone = []
        for name in self.ranges:
            value = F.when(~comes, F.col(f"_range_{name}"))
            gone += [F.min(value).alias(f"_lost_{name}_min"), F.max(value).alias(f"_lost_{name}_max")]
        added = f"{CHANGE_TYPE} IN ('{INSERT}', '{UPDATE_AFTER}')"
        delta = self._rows(feed).groupBy(*cols(self.groups)).agg(
            F.sum(sign).alias(COUNT), *sums, *gone, *self._range_aggregates(added)
        )
        delta.write.parquet(f"{folder}/delta")
        delta = spark.read.schema(delta.schema).parquet(f"{folder}/delta")

        slices = None if self.store.slice_by is None else self.store.slices_of(delta)
        view = self.store.read(slices=slices)
        met = delta.alias("d").join(view.alias("v"), same_keys("d", "v", self.groups), "left")
        total = {n: F.col(f"d.{n}") + F.coalesce(F.col(f"v.{n}"), F.lit(0)) for n in (COUNT, *self.sums)}
        columns = [F.col(f"d.{quoted(g)}").alias(g) for g in self.groups]
        columns += [e.cast(view.schema[n].dataType).alias(n) for n, e in total.items()]
        stale = F.lit(False)
        for name in self.ranges:
            for end, pick in (("min", F.least), ("max", F.greatest)):
                held, came, lost = (F.col(f"{p}{name}_{end}") for p in ("v.", "d.", "d._lost_"))
                columns.append(pick(held, came).alias(f"{name}_{end}"))
                at_end = lost <= held if end == "min" else lost >= held
                stale = stale | F.coalesce(at_end, F.lit(False))
        merged = met.select(*columns, stale.alias("_stale"))
        merged.write.parquet(f"{folder}/merged")
        merged = spark.read.schema(merged.schema).parquet(f"{folder}/merged")
        if not self.ranges:
            return merged.drop("_stale"), slices
        again = merged.filter(F.col("_stale") & (F.col(COUNT) > 0)).select(*cols(self.groups))
        if again.isEmpty():
            return merged.drop("_stale"), slices
        # Spark broadcasts the groups where its own size check allows; the source is then not moved.
        rows = self._rows(self.source.read(newest)).alias("s")
        rows = rows.join(again.alias("a"), same_keys("s", "a", self.groups), "left_semi")
        looked_up = rows.groupBy(*cols(self.groups)).agg(*self._range_aggregates())
        joined = merged.alias("m").join(looked_up.alias("l"), same_keys("m", "l", self.groups), "left")
        ends = {f"{n}_{end}" for n in self.ranges for end in ("min", "max")}

        def value(name: str) -> Column:
            kept = F.col(f"m.{quoted(name)}")
            if name not in ends:
                return kept.alias(name)
            return F.when(F.col("m._stale"), F.col(f"l.{name}")).otherwise(kept).alias(name)

        return joined.select(*[value(n) for n in merged.columns if n != "_stale"]), slices
