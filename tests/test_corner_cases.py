"""Null slices, schema changes, zones and clocks, collations, and runs that fail."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.changes import apply_changes, catch_up, change_feed
from tidegauge.operators.profile import profile_dataframe
from tidegauge.plans.ingest import ingest
from tidegauge.plans.tables import FeedReader, upsert_table
from tidegauge.session import scratch
from tidegauge.sources.increments import SOURCE_SCHEMA
from tidegauge.sources.versions import VersionedTable
from tidegauge.streaming.backfill import UndatedRowsError, land_in_order
from tidegauge.streaming.flows import FlowTarget, run_flow, settings
from tidegauge.streaming.joins import fixed_micros, interval_join
from tidegauge.streaming.sources import stream_table
from tidegauge.streaming.windows import windowed_counts_sql


def table(spark, slice_by=None):
    return VersionedTable(spark, scratch(spark, "t"), slice_by)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def joins_of(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.lstrip("+-: ").startswith("Join ") for line in plan.splitlines())


def test_null_slices_are_kept_and_replaced(spark):
    schema = "k1 bigint, k2 bigint, v string"
    stored = table(spark, F.col("k1"))
    stored.publish(spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (5, 3, "c")], schema))
    upsert_table(stored, spark.createDataFrame([(None, 9, "n"), (None, 2, "B")], schema), ["k1", "k2"])
    assert rows(stored.read()) == sorted(
        [(None, 1, "a"), (None, 2, "B"), (None, 9, "n"), (5, 3, "c")], key=str
    )
    upsert_table(stored, spark.createDataFrame([(None, 1, "A"), (5, 3, "C"), (6, 1, "d")], schema), ["k1", "k2"])
    assert stored.read().count() == 5 and stored.read(slices=[None]).count() == 3
    assert rows(stored.read(slices=[5])) == [(5, 3, "C")]


def test_an_older_row_never_replaces_a_newer_one(spark):
    schema = "k bigint, ts int, v string"
    stored = table(spark)
    for batch in ([(1, 10, "new"), (2, 1, "x")], [(1, 5, "old"), (2, 2, "y"), (None, 1, "n")]):
        upsert_table(stored, spark.createDataFrame(batch, schema), ["k"], ["ts"])
    assert rows(stored.read()) == sorted([(1, 10, "new"), (2, 2, "y"), (None, 1, "n")], key=str)


def test_one_join_is_enough(spark):
    target = spark.createDataFrame([(1, 1, False)], "k bigint, ts int, _deleted boolean")
    changes = spark.createDataFrame([(1, 2)], "k bigint, ts int")
    assert joins_of(apply_changes(target, changes, ["k"], ["ts"])) == 1
    assert joins_of(catch_up(changes, changes.filter("k = 0"), ["k"], ["ts"])) == 1


def test_change_feed_after_a_schema_change(spark):
    before = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, gone int")
    after = spark.createDataFrame([(1, "a", 7.5), (3, "c", None)], "k int, v string, more double")
    found = change_feed(before, after, ["k"])
    assert found.columns == ["k", "v", "more", "gone", "_change_type"]
    assert rows(found) == sorted(
        [
            (1, "a", None, 0, "update_preimage"),
            (1, "a", 7.5, None, "update_postimage"),
            (2, "b", None, 0, "delete"),
            (3, "c", None, None, "insert"),
        ],
        key=str,
    )


def test_a_reader_that_fails_gets_the_same_changes_again(spark):
    stored = table(spark)
    reader = FeedReader(stored, scratch(spark, "positions"), "r")
    assert reader.run(["k"], lambda feed: None) is None
    stored.publish(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(RuntimeError):
        reader.run(["k"], lambda feed: (_ for _ in ()).throw(RuntimeError()))
    seen = []
    assert reader.run(["k"], lambda feed: seen.extend(rows(feed))) == 1
    assert reader.run(["k"], lambda feed: seen.append("never")) == 1
    assert seen == [(1, "a", "insert", 1)]


def test_late_rows_of_the_watermark_day_and_a_failed_run(spark):
    registry = spark.createDataFrame([("s", "t", "id", "day", "date", None, None, None)], SOURCE_SCHEMA)
    target, control = table(spark), table(spark)
    first = [(1, date(2024, 5, 1))]
    second = [*first, (2, date(2024, 5, 1))]

    def run(data, broken=False):
        def read(source):
            if broken:
                raise LookupError("gone")
            return spark.createDataFrame(data, "id int, day date")

        return ingest(registry, read, lambda s: target, control, logic=lambda s: "2" if data is None else "1")

    run(first), run(second)
    assert target.read().count() == 2
    status = run(second, broken=True).first()
    stored = control.read().first()
    assert (status.status, stored.last_run_status, stored.watermark_value) == ("failed", "failed", "2024-05-01")


def test_sources_run_side_by_side_without_losing_control_rows(spark):
    names = [f"t{k}" for k in range(6)]
    registry = spark.createDataFrame([("s", n, "id", "at", "bigint", None, None, None) for n in names], SOURCE_SCHEMA)
    control, targets = table(spark), {n: table(spark) for n in names}
    data = spark.createDataFrame([(1, 5)], "id int, at bigint")
    ingest(registry, lambda s: data, lambda s: targets[s.source_table], control, threads=6)
    assert sorted(r.source_table for r in control.read().collect()) == names


def test_bounds_in_fixed_units():
    assert fixed_micros("0 SECONDS") == 0 and fixed_micros("1 day 2 hours") == 26 * 3_600_000_000
    for text in ("2 MONTHS", "1 year", "soon", "", "1 day 1 month"):
        with pytest.raises(ValueError):
            fixed_micros(text)


@pytest.mark.parametrize("within,micros", [("0 SECONDS", 0), ("90 MINUTES", 5_400_000_000), ("1 DAY", 86_400_000_000)])
def test_interval_join_over_a_clock_change(spark, within, micros):
    with settings(spark, **{"spark.sql.session.timeZone": "America/New_York"}):
        start = 1_710_000_000  # the night of 2024-03-10
        at = F.timestamp_seconds(F.col("id") * 1800 + start)
        left = spark.range(120).select(F.lit(1).alias("k"), at.alias("lt"), F.col("id").alias("a"))
        right = spark.range(240).select(
            F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 900 + start).alias("rt"), F.col("id").alias("b")
        )
        found = interval_join(left, right, ["k"], "lt", "rt", within, "1 hour", "1 hour", "inner", salts=3)
        want = sum(0 <= (b * 900 - a * 1800) * 1_000_000 <= micros for a in range(120) for b in range(240))
        assert found.count() == want


def test_profile_of_variants_zones_and_collations(spark):
    with settings(spark, **{"spark.sql.session.timeZone": "America/New_York"}):
        df = spark.sql(
            """
            SELECT parse_json(v) AS v, timestamp_seconds(s) AS at, c COLLATE UTF8_LCASE AS c FROM VALUES
            ('{"a": 1}', 1730610000, 'short'), ('{"a":1}', 1730613000, 'SHORT'),
            (NULL, 1730614200, repeat('Long', 40)), ('[2]', 1730614200, repeat('lONG', 40)) t(v, s, c)
            """
        )
        found = {r.column_name: r for r in profile_dataframe(df).collect()}
    assert (found["v"].null_count, found["v"].distinct_count) == (1, 2)
    assert found["at"].max_value == "2024-11-03 01:50:00" and found["at"].distinct_count == 3
    assert found["c"].distinct_count == 2


def test_progress_of_more_batches_than_the_session_keeps(spark, folder):
    for k in range(7):
        spark.range(10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = stream_table(spark, f"{folder}/in", max_files=1)
    with settings(spark, **{"spark.sql.streaming.numRecentProgressUpdates": "2"}):
        run = run_flow(stream, f"{folder}/checkpoint", "many", path=f"{folder}/out")
    assert run.input_rows == 70 and len({p["batchId"] for p in run.progress}) >= 7


def test_flow_state_is_never_missing(spark, folder):
    target = FlowTarget(spark, folder)
    for k in range(4):
        target.full_refresh("f")
        names = target.files.children(f"{folder}/_flows/f")
        assert len(names) <= 2 and target.state("f")["current"] == k + 2
    assert target.flows() == ["f"]


def test_sql_windows_without_keys(spark, folder):
    spark.sql("SELECT timestamp_seconds(id * 60) AS ts FROM range(300)").write.parquet(f"{folder}/in")
    stream = stream_table(spark, f"{folder}/in")
    counts = windowed_counts_sql(stream, "ts", "1 minute", "1 hour", [])
    run_flow(counts, f"{folder}/checkpoint", "w", path=f"{folder}/out")
    assert [r.n for r in spark.read.parquet(f"{folder}/out").collect()] == [60] * 4
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stream_")]


def test_backfill_accounts_for_rows_without_event_time(spark, folder):
    history = spark.sql("SELECT id, if(id % 5 = 0, NULL, timestamp_seconds(id * 100)) AS ts FROM range(50)")
    with pytest.raises(UndatedRowsError):
        land_in_order(history, "ts", 1000, f"{folder}/landing")
    land_in_order(history, "ts", 1000, f"{folder}/landing", undated=f"{folder}/undated")
    landed, undated = (spark.read.parquet(f"{folder}/{n}") for n in ("landing", "undated"))
    assert landed.count() == 40 and undated.count() == 10
