"""Queries on what follows a table's changes: stored feeds, streams of them, views, merged profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.plans.profile_states import ProfileStates
from tidegauge.plans.tables import (
    FeedReader,
    apply_changes_table,
    digests,
    read_changes,
    upsert_table,
)
from tidegauge.plans.views import GroupView
from tidegauge.queries.base import Registry, table
from tidegauge.queries.incremental import register as _incremental
from tidegauge.queries.profiles import METRICS, MOMENT_DIGITS, profile_sql
from tidegauge.session import scratch
from tidegauge.sources.feed_source import stream_changes
from tidegauge.sources.versions import VersionedTable
from tidegauge.streaming.flows import run_flow

register = Registry()

_COLUMNS = ["c_custkey", "c_acctbal", "c_mktsegment"]
_FEED = _incremental.oracles["feed_consumer"]


def _tracked(spark: SparkSession, label: str) -> VersionedTable:
    return VersionedTable(spark, scratch(spark, label), F.floor(F.col("c_custkey") / 1000), track_changes=True)


def _segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All customers but one segment, that segment, and another one with changed balances."""
    customers = table(spark, sf_dir, "customer").select(*_COLUMNS)
    kind = F.col("c_mktsegment")
    machinery = customers.filter(kind == "MACHINERY").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return customers.filter(kind != "BUILDING"), customers.filter(kind == "BUILDING"), machinery


@register("stored_change_feed", f"SELECT * EXCLUDE (run) FROM ({_FEED}) WHERE _commit_version > 1")
def stored_change_feed(spark, sf_dir):
    """Change rows written with their commits; rows that an upsert brings unchanged are none."""
    first, building, machinery = _segments(spark, sf_dir)
    stored = _tracked(spark, "tracked")
    stored.publish(first)
    upsert_table(stored, building, ["c_custkey"])
    same = first.filter("c_mktsegment = 'AUTOMOBILE'")
    upsert_table(stored, machinery.unionByName(same), ["c_custkey"])
    feed = read_changes(stored, ["c_custkey"], after=1, on_change="feed")
    return feed.select("c_custkey", "c_acctbal", "_change_type", "_commit_version")


@register("stream_change_feed", f"SELECT * FROM ({_FEED}) WHERE _commit_version > 1")
def stream_change_feed(spark, sf_dir):
    """The same changes as a stream, the second run going on from its checkpoint."""
    first, building, machinery = _segments(spark, sf_dir)
    stored = _tracked(spark, "streamed")
    folder = scratch(spark, "feed-stream")

    def follow(run: int) -> None:
        feed = stream_changes(stored, after=1, on_change="feed").withColumn("run", F.lit(run))
        run_flow(feed, f"{folder}/checkpoint", "feed", path=f"{folder}/rows")

    stored.publish(first)
    upsert_table(stored, building, ["c_custkey"])
    upsert_table(stored, machinery, ["c_custkey"])
    follow(2)
    upsert_table(stored, building, ["c_custkey"])  # changes nothing
    follow(3)
    rows = spark.read.parquet(f"{folder}/rows")
    return rows.select("c_custkey", "c_acctbal", "_change_type", "_commit_version", "run")


@register(
    "view_affected_groups",
    """
    SELECT c_nationkey, count(*) AS n, sum(balance) AS balance, min(balance) AS balance_min,
           max(balance) AS balance_max
    FROM (SELECT c_nationkey, CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 * c_acctbal ELSE c_acctbal END
              AS DECIMAL(18, 2)) AS balance
          FROM customer WHERE c_mktsegment <> 'FURNITURE')
    GROUP BY c_nationkey
    """,
)
def view_affected_groups(spark, sf_dir):
    """A view refreshed after inserts, after updates and deletes, equal to one computed from all rows."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    kind = F.col("c_mktsegment")
    stored = _tracked(spark, "view-source")
    balance = F.col("balance")
    view = GroupView(
        VersionedTable(spark, scratch(spark, "view")), stored, ["c_custkey"], ["c_nationkey"],
        sums={"balance": balance}, ranges={"balance": balance}, where=~F.col("_deleted"),
    )
    doubled = customers.withColumn("balance", F.when(kind == "MACHINERY", (2 * balance).cast("decimal(18,2)")).otherwise(balance))
    steps = [
        customers.filter(kind != "BUILDING").withColumn("step", F.lit(1)),
        customers.filter(kind == "BUILDING").withColumn("step", F.lit(2)),
        doubled.filter(kind.isin("MACHINERY", "FURNITURE")).withColumn("step", F.lit(3)),
    ]
    gone = (kind == "FURNITURE") & (F.col("step") == 3)
    for changes in steps:
        apply_changes_table(stored, changes, ["c_custkey"], ["step"], gone)
        view.refresh()
    return view.read()


_MERGED = profile_sql(["customer"], METRICS, table_column=None).replace("FROM customer", "FROM changed")


@register(
    "profile_merged",
    f"""
    WITH changed AS (
        SELECT * REPLACE (CASE WHEN c_custkey < 300 THEN -c_custkey - 1 ELSE c_acctbal END AS c_acctbal,
                          CASE WHEN c_custkey < 300 THEN NULL ELSE c_mktsegment END AS c_mktsegment)
        FROM customer WHERE c_custkey < 300 OR c_mktsegment <> 'BUILDING')
    {_MERGED}
    """,
)
def profile_merged(spark, sf_dir):
    """A profile after an upsert, from the states of all slices, of which few are read again."""
    customers = table(spark, sf_dir, "customer")
    stored = VersionedTable(spark, scratch(spark, "profiled"), F.floor(F.col("c_custkey") / 300))
    states = ProfileStates(stored, scratch(spark, "profile-states"))
    stored.publish(customers.filter("c_mktsegment <> 'BUILDING'"))
    states.refresh()
    low = customers.filter("c_custkey < 300").withColumn("c_acctbal", -F.col("c_custkey").cast("double") - 1)
    upsert_table(stored, low.withColumn("c_mktsegment", F.lit(None).cast("string")), ["c_custkey"])
    moments = ("mean", "stddev_pop", "cv")
    picked = [F.round(m, MOMENT_DIGITS).alias(m) if m in moments else F.col(m) for m in METRICS]
    return states.profile().select(*picked)


@register(
    "feed_resync",
    """
    SELECT c_custkey, c_acctbal, 'insert' AS _change_type, 1 AS _commit_version FROM customer
    WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT c_custkey, c_acctbal, 'insert', 3 FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, c_acctbal + 1, 'update_postimage', 3 FROM customer
    WHERE c_mktsegment = 'MACHINERY'
    """,
)
def feed_resync(spark, sf_dir):
    """A reader that fell behind what is kept finds what it lacks by the digests of its own rows."""
    first, building, machinery = _segments(spark, sf_dir)
    stored, folder = _tracked(spark, "resync"), scratch(spark, "resync-reader")
    reader = FeedReader(stored, f"{folder}/positions", "behind")

    def seen() -> DataFrame:
        return spark.read.parquet(f"{folder}/seen")

    def run() -> None:
        reader.run(
            ["c_custkey"], lambda feed: feed.write.mode("append").parquet(f"{folder}/seen"),
            state=lambda: digests(seen().select(*_COLUMNS), ["c_custkey"]),
        )

    stored.publish(first)
    run()
    upsert_table(stored, building, ["c_custkey"])
    upsert_table(stored, machinery, ["c_custkey"])
    stored.expire(keep=1)
    run()
    return seen().select("c_custkey", "c_acctbal", "_change_type", "_commit_version")
