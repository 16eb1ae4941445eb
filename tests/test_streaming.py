import time
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidegauge.operators.joins import dimension_join
from tidegauge.plans.layers import clean_events
from tidegauge.session import scratch
from tidegauge.sources.versions import VersionedTable
from tidegauge.streaming.backfill import land_in_order, split_history
from tidegauge.streaming.dedup import deduplicated
from tidegauge.streaming.flows import (
    FlowTarget,
    ResetNotAllowed,
    _once_per_batch,
    run_flow,
    state_partitions,
    upsert_flow,
)
from tidegauge.streaming.joins import UnboundedStateError, interval_join
from tidegauge.streaming.monitor import flow_metrics, late_audit
from tidegauge.streaming.sources import stream_table
from tidegauge.streaming.windows import session_counts, windowed_counts, windowed_counts_sql

HDFS = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def at(text):
    return datetime.strptime(f"2024-05-01 {text}", "%Y-%m-%d %H:%M")


class Landing:
    """A folder that files with event times are put into, one after the other."""

    def __init__(self, spark):
        self.spark, self.path = spark, scratch(spark, "landing")

    def file(self, *times, schema="event_time timestamp, region string"):
        rows = [(at(t), "r") if isinstance(t, str) else t for t in times]
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self.path)
        time.sleep(0.02)  # modification times must differ
        return self

    def stream(self, max_files=None):
        return stream_table(self.spark, self.path, max_files=max_files)


class Counting:
    """A windowed count with its checkpoint and output."""

    def __init__(self, spark, delay="10 minutes", size="5 minutes"):
        self.spark, self.delay, self.size = spark, delay, size
        self.folder = scratch(spark, "counting")

    def run(self, stream, **options):
        counts = windowed_counts(stream, "event_time", self.delay, self.size, ["region"])
        return run_flow(counts, f"{self.folder}/c", "counts", path=f"{self.folder}/o", **options)

    def out(self):
        rows = self.spark.read.parquet(f"{self.folder}/o").collect()
        return sorted((r["window_start"].strftime("%H:%M"), r["n"]) for r in rows)


def test_windows_close_and_the_watermark_persists(spark):
    landing, counting = Landing(spark), Counting(spark)
    landing.file("12:01", "12:02").file("12:30")
    run = counting.run(landing.stream(max_files=1))
    assert counting.out() == [("12:00", 2)]
    assert run.watermark == "2024-05-01T12:20:00.000Z" and run.input_rows == 3

    landing.file("12:10").file("12:25").file("13:30")
    run = counting.run(landing.stream(max_files=1))
    assert counting.out() == [("12:00", 2), ("12:25", 1), ("12:30", 1)]
    assert run.dropped_rows == 1
    metrics = flow_metrics(spark, [run])
    assert metrics.agg(F.sum("rows_dropped"), F.sum("input_rows")).first() == (1, 3)

    run = counting.run(landing.stream(max_files=1))  # nothing new: nothing read twice
    assert run.input_rows == 0 and len(counting.out()) == 3


def test_backfill_trap_and_its_ways_out(spark):
    trap = ("15:00", "15:01", "10:00", "18:00")
    landing = Landing(spark)
    for t in trap:
        landing.file(t)

    caught = Counting(spark)
    assert caught.run(landing.stream(max_files=1)).dropped_rows == 1
    assert "10:00" not in dict(caught.out())

    one_batch = Counting(spark)
    assert one_batch.run(landing.stream()).dropped_rows == 0
    assert "10:00" in dict(one_batch.out())

    widened = Counting(spark, delay="30 days")
    assert widened.run(landing.stream(max_files=1)).dropped_rows == 0
    assert widened.out() == []

    ordered, target = Counting(spark), f"{scratch(spark, 'ordered')}"
    history = spark.read.parquet(landing.path)
    runs = land_in_order(
        history, "event_time", 3600, target,
        lambda number: ordered.run(stream_table(spark, target, history.schema)),
    )
    assert len(runs) == 3 and sum(r.dropped_rows for r in runs) == 0
    assert [w for w, _ in ordered.out()] == ["10:00", "15:00"]


def test_split_history_keeps_every_row_of_a_hot_slice(spark):
    history = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id") * 60).cast("timestamp").alias("t"), "id"
    )
    folder, slices, undated = split_history(history, "t", 3600)
    assert slices == sorted(slices) and slices[0] == 0
    assert spark.read.parquet(folder).count() == 3000


def test_state_stores_give_the_same(spark):
    landing = Landing(spark).file("12:01", "12:02").file("12:30")
    results = []
    for options in ({}, {"state_store": HDFS}):
        counting = Counting(spark)
        counting.run(landing.stream(), **options)
        results.append(counting.out())
    assert results[0] == results[1] == [("12:00", 2)]
    assert state_partitions(spark) == 4


def test_changed_grouping_on_an_old_checkpoint_fails(spark):
    landing, counting = Landing(spark), Counting(spark)
    counting.run(landing.file("12:01").stream())
    landing.file("12:40")
    other = windowed_counts(landing.stream(), "event_time", "10 minutes", "5 minutes", [])
    with pytest.raises(Exception, match="STATE_STORE|schema"):
        run_flow(other, f"{counting.folder}/c", "counts", path=f"{counting.folder}/o2")


def test_sql_and_dataframe_windows_agree(spark):
    landing = Landing(spark).file("12:01", "12:02", "12:07", "12:30")
    counting = Counting(spark)
    counting.run(landing.stream())
    by_sql = windowed_counts_sql(landing.stream(), "event_time", "10 MINUTES", "5 minutes", ["region"])
    folder = scratch(spark, "sql")
    run_flow(by_sql, f"{folder}/c", "sql", path=f"{folder}/o")
    rows = spark.read.parquet(f"{folder}/o").collect()
    assert sorted((r["window_start"].strftime("%H:%M"), r["n"]) for r in rows) == counting.out()


def test_append_aggregates_and_dedup_need_a_watermark(spark):
    stream = Landing(spark).file("12:00").stream()
    folder = scratch(spark, "bad")
    bare = stream.groupBy("region").count()
    with pytest.raises(AnalysisException):
        run_flow(bare, f"{folder}/c1", "bad", path=f"{folder}/o1")
    with pytest.raises(AnalysisException):
        run_flow(stream.dropDuplicatesWithinWatermark(["region"]), f"{folder}/c2", "bad", path=f"{folder}/o2")
    with pytest.raises(ValueError):
        run_flow(stream, f"{folder}/c3", "bad")


def test_sessions(spark):
    landing = Landing(spark).file("12:00", "12:04", "12:20", "14:00")
    counts = session_counts(landing.stream(), "event_time", "10 minutes", "5 minutes", ["region"])
    folder = scratch(spark, "sessions")
    run_flow(counts, f"{folder}/c", "sessions", path=f"{folder}/o")
    rows = spark.read.parquet(f"{folder}/o").collect()
    assert sorted((r["window_start"].strftime("%H:%M"), r["window_end"].strftime("%H:%M"), r["n"]) for r in rows) == [
        ("12:00", "12:09", 2), ("12:20", "12:25", 1),
    ]


@pytest.mark.parametrize("thin", [False, True])
def test_dedup_over_batches_and_runs(spark, thin):
    schema = "event_time timestamp, id int"
    landing = Landing(spark)
    hot = [(at("12:00"), 1)] * 50
    landing.file(*hot, (at("12:01"), 2), schema=schema).file(*hot, (at("12:02"), 3), schema=schema)
    folder = scratch(spark, "dedup")
    for extra in ([(at("12:03"), 4)], [(at("12:01"), 2), (at("12:03"), 4)]):
        landing.file(*extra, schema=schema)
        rows = deduplicated(landing.stream(max_files=1), "event_time", "10 minutes", ["id"], thin)
        run_flow(rows, f"{folder}/c", "dedup", path=f"{folder}/o")
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/o").collect()) == [1, 2, 3, 4]


def test_a_late_copy_does_not_hide_a_timely_one(spark):
    schema = "event_time timestamp, id int"
    landing = Landing(spark).file((at("12:00"), 1), schema=schema)
    folder = scratch(spark, "dedup")
    for more in ([(at("14:00"), 2)], [(at("12:30"), 3), (at("14:05"), 3), (at("12:31"), 3)]):
        landing.file(*more, schema=schema)
        rows = deduplicated(landing.stream(), "event_time", "10 minutes", ["id"])
        run_flow(rows, f"{folder}/c", "dedup", path=f"{folder}/o")
    found = spark.read.parquet(f"{folder}/o").collect()
    assert sorted((r["id"], r["event_time"]) for r in found)[-1] == (3, at("14:05"))


IMPRESSIONS = "ad_id string, impression_time timestamp"
CLICKS = "ad_id string, click_time timestamp"


def joined(spark, impressions, clicks, how, **delays):
    imp = Landing(spark).file(*impressions, schema=IMPRESSIONS)
    clk = Landing(spark).file(*clicks, schema=CLICKS)
    rows = interval_join(
        imp.stream(), clk.stream(), ["ad_id"], "impression_time", "click_time", "3 MINUTES",
        "3 minutes", "3 minutes", how,
    )
    folder = scratch(spark, "join")
    run_flow(rows, f"{folder}/c", "join", path=f"{folder}/o")
    return sorted((r["ad_id"], r["right_ad_id"]) for r in spark.read.parquet(f"{folder}/o").collect())


def test_interval_joins(spark):
    impressions = [("a", at("12:00")), ("b", at("12:00")), ("z", at("13:00"))]
    clicks = [("a", at("12:02")), ("b", at("12:09")), ("y", at("13:00"))]
    outer = joined(spark, impressions, clicks, "leftOuter")
    assert outer == [("a", "a"), ("b", None)]
    assert joined(spark, impressions, clicks, "inner") == [("a", "a")]


def test_interval_join_meets_every_pair_once_at_bucket_edges(spark):
    minutes = [f"12:{m:02d}" for m in range(0, 12)]
    impressions = [("a", at(t)) for t in minutes]
    clicks = [("a", at(t)) for t in minutes]
    pairs = sum(1 for i in range(12) for c in range(12) if 0 <= c - i <= 3)
    assert len(joined(spark, impressions, clicks, "inner")) == pairs


def test_unbounded_joins_are_refused(spark):
    left, right = spark.range(1), spark.range(1)
    for bounds in ((None, "1 minute", "1 minute"), ("1 minute", None, "1 minute"), ("1 minute", "1 minute", "")):
        left_delay, right_delay, within = bounds
        with pytest.raises(UnboundedStateError):
            interval_join(left, right, ["id"], "t", "u", within, left_delay, right_delay, "inner")


def test_static_join_small_and_salted(spark):
    landing = Landing(spark).file("12:00", "12:01", "12:02")
    dimension = spark.createDataFrame([("r", "north")], "region string, name string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit, salts in ((threshold, 16), ("-1", 4)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            rows = dimension_join(landing.stream(), dimension, ["region"], salts=salts)
            folder = scratch(spark, "static")
            run_flow(rows, f"{folder}/c", "static", path=f"{folder}/o")
            found = spark.read.parquet(f"{folder}/o")
            assert "_salt" not in found.columns
            assert [r["name"] for r in found.collect()] == ["north"] * 3
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_watermark_policies(spark):
    fast, slow = Landing(spark).file("20:00"), Landing(spark).file("10:00")
    for policy, expected in (("min", []), ("max", ["10:00"])):
        union = fast.stream().withWatermark("event_time", "10 minutes").union(
            slow.stream().withWatermark("event_time", "5 minutes")
        )
        counts = union.groupBy(F.window("event_time", "5 minutes").alias("w")).count()
        folder = scratch(spark, "policy")
        run_flow(counts, f"{folder}/c", "policy", path=f"{folder}/o", watermark_policy=policy)
        rows = spark.read.parquet(f"{folder}/o").collect()
        assert [r["w"]["start"].strftime("%H:%M") for r in rows] == expected


def test_two_flows_and_resets(spark):
    one, two = Landing(spark).file("12:00"), Landing(spark).file("13:00", "13:01")
    target = FlowTarget(spark, scratch(spark, "target"))
    with pytest.raises(LookupError):
        target.read()
    target.append("one", one.stream())
    target.append("two", two.stream())
    assert {r["flow"]: r["count"] for r in target.read().groupBy("flow").count().collect()} == {"one": 1, "two": 2}
    target.append("one", one.stream())  # nothing new
    assert target.read().count() == 3

    target.reset_checkpoint("one")  # data kept, source read again
    target.append("one", one.stream())
    assert target.read(["one"]).count() == 2 and target.read(["one"]).distinct().count() == 1

    target.full_refresh("one")
    target.append("one", one.stream())
    assert target.read(["one"]).count() == 1

    shouting = one.stream().withColumn("region", F.upper("region"))
    target.append("one", shouting, logic="2")  # changed logic falls back to a refresh
    assert [r["region"] for r in target.read(["one"]).collect()] == ["R"]

    guarded = FlowTarget(spark, target.path, reset_allowed=False)
    for reset in (guarded.full_refresh, guarded.reset_checkpoint):
        with pytest.raises(ResetNotAllowed):
            reset("one")


def test_upsert_flow_repeats_are_harmless(spark):
    landing = Landing(spark).file("12:00").file("12:05")
    table = VersionedTable(spark, scratch(spark, "upserts"))
    folder = scratch(spark, "flow")

    def run(checkpoint):
        stream = landing.stream(max_files=1)
        upsert_flow(stream, table, ["region"], ["event_time"], checkpoint, "f")
        return [r["event_time"] for r in table.read().collect()]

    assert run(f"{folder}/c") == run(f"{folder}/c") == [at("12:05")]
    assert len(table.versions()) == 2

    # A batch the engine repeats after a stop is passed over.
    calls = []
    each = _once_per_batch(table, f"{folder}/c", lambda rows, batches: calls.append(batches))
    each(spark.range(1), 1)
    assert calls == []
    each(spark.range(1), 2)
    assert len(calls) == 1

    # A new checkpoint is no repeat: its batches are read and upserted again.
    assert run(f"{folder}/other") == [at("12:05")]
    assert len(table.versions()) == 4


def test_single_files_can_be_streamed(spark, folder):
    path = "/root/testdata/sf0.001/nation.parquet"
    run = run_flow(stream_table(spark, path), f"{folder}/c", "n", path=f"{folder}/o")
    assert run.input_rows == spark.read.parquet(f"{folder}/o").count() == 25


def test_late_audit(spark):
    df = spark.createDataFrame([(at("12:00"),), (at("12:20"),), (at("12:30"),)], "t timestamp")
    found = {r["late"]: r["rows"] for r in late_audit(df, "t", "2024-05-01 12:20:00").collect()}
    assert found == {True: 1, False: 2}


def test_clean_events(spark):
    raw = spark.createDataFrame(
        [(1, at("12:00"), 5, " View ", "12.5", '{"k": 3}'), (None, at("12:00"), 1, "x", "1", "{}"),
         (2, at("12:00"), 5, "click", "oops", "not json")],
        "event_id int, ts timestamp, user_id int, event_type string, value string, props string",
    )
    rows = {r["event_id"]: r for r in clean_events(raw).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["event_type"], float(rows[1]["amount"]), rows[1]["k"]) == ("view", 12.5, 3)
    assert (rows[2]["amount"], rows[2]["k"]) == (None, None)
