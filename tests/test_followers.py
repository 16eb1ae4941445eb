"""Stored change rows, streams of them, and views refreshed from them."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidegauge.operators.changes import UpstreamChangeError
from tidegauge.plans.tables import (
    FeedReader,
    apply_changes_table,
    digests,
    read_changes,
    resync,
    upsert_table,
)
from tidegauge.plans.views import GroupView
from tidegauge.session import scratch
from tidegauge.sources.feed_source import stream_changes
from tidegauge.sources.versions import VersionedTable
from tidegauge.streaming.flows import run_flow

ROW = "k int, g string, v bigint"


def table_of(spark, label, track=True, sliced=True):
    by = F.floor(F.col("k") / 10) if sliced else None
    return VersionedTable(spark, scratch(spark, label), by, track_changes=track)


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROW)


FIRST = [(k, "ab"[k % 2], k) for k in range(1, 40)] + [(None, "a", 5)]
STEPS = [
    [(3, "a", 30), (7, "b", 7), (50, None, 1)],  # 7 stays as it was
    [(60, "c", 6), (61, "c", 7)],  # an append
    [(None, "b", 9), (50, "a", None)],
]


def written(spark, label, **options):
    stored = table_of(spark, label, **options)
    stored.publish(rows(spark, *FIRST))
    for step in STEPS:
        upsert_table(stored, rows(spark, *step), ["k"])
    return stored


def listed(df):
    columns = ["k", "g", "v", "_change_type", "_commit_version"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("sliced", [True, False])
def test_stored_changes_equal_compared_versions(spark, sliced):
    tracked = written(spark, "tracked", sliced=sliced)
    plain = written(spark, "plain", track=False, sliced=sliced)
    feed = read_changes(tracked, ["k"], 1, on_change="feed")
    assert listed(feed) == listed(read_changes(plain, ["k"], 1, on_change="feed"))
    assert "Join" not in feed._jdf.queryExecution().executedPlan().toString()
    same = [sorted(t.read().collect(), key=str) for t in (tracked, plain)]
    assert same[0] == same[1] and "_change_type" not in tracked.read().columns
    assert [r[0] for r in listed(read_changes(tracked, ["k"], 2, 3))] == [60, 61]
    with pytest.raises(UpstreamChangeError):
        read_changes(tracked, ["k"], 1)


def test_changes_applied_in_any_order_are_stored(spark):
    tracked, plain = (table_of(spark, n, track=n == "t") for n in ("t", "p"))
    for stored in (tracked, plain):
        for batch in ([(1, "a", 5), (2, "a", 5)], [(1, "b", 4), (2, "x", 6)], [(2, "c", 7), (3, "c", 1)]):
            apply_changes_table(stored, rows(spark, *batch), ["k"], ["v"], F.col("g") == "x")
    found = [listed(read_changes(t, ["k"], 1, on_change="feed")) for t in (tracked, plain)]
    assert found[0] == found[1] and len(found[0]) == 5


def test_expired_versions_take_their_changes_along(spark):
    stored = written(spark, "expiring")
    before = sorted(stored.read().collect(), key=str)
    stored.expire(keep=2)
    assert sorted(stored.read().collect(), key=str) == before
    assert listed(read_changes(stored, ["k"], 3, on_change="feed"))
    assert stored.stored_changes(4).count() > 0


def follow(spark, stored, folder, on_change="feed", after=1):
    feed = stream_changes(stored, after, on_change)
    run = run_flow(feed, f"{folder}/c", "feed", path=f"{folder}/o")
    return listed(spark.read.schema(feed.schema).parquet(f"{folder}/o")), run


def test_stream_of_changes_goes_on_from_its_checkpoint(spark):
    stored, folder = written(spark, "streamed"), scratch(spark, "follow")
    want = listed(read_changes(stored, ["k"], 1, on_change="feed"))
    assert follow(spark, stored, folder)[0] == want
    assert follow(spark, stored, folder)[1].input_rows == 0
    upsert_table(stored, rows(spark, (1, "z", 1)), ["k"])
    assert follow(spark, stored, folder)[0] == listed(read_changes(stored, ["k"], 1, on_change="feed"))


def test_policies_of_the_stream(spark):
    stored = written(spark, "policies")
    skipped = listed(read_changes(stored, ["k"], 1, on_change="skip"))
    assert follow(spark, stored, scratch(spark, "skip"), "skip")[0] == skipped
    with pytest.raises(StreamingQueryException, match="commit 2 updates or deletes rows"):
        follow(spark, stored, scratch(spark, "fail"), "fail")
    stored.expire(keep=1)
    with pytest.raises(StreamingQueryException, match="not kept any more"):
        follow(spark, stored, scratch(spark, "lost"))
    with pytest.raises(ValueError):
        stream_changes(stored, 1, "ignore")


def test_stream_sees_no_unpublished_version(spark):
    stored, folder = written(spark, "unpublished"), scratch(spark, "unseen")
    draft = f"{stored.path}/v=000005/slice_id=changes"
    rows(spark, (9, "x", 9)).withColumn("_change_type", F.lit("insert")).write.parquet(draft)
    assert all(r[-1] <= 4 for r in follow(spark, stored, folder)[0])


def test_wider_rows_in_the_stream(spark):
    stored, folder = table_of(spark, "wide"), scratch(spark, "wide-out")
    stored.publish(rows(spark, (1, "a", 1)))
    upsert_table(stored, rows(spark, (2, "b", 2)), ["k"])
    more = rows(spark, (3, "c", 3)).withColumn("at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    upsert_table(stored, more, ["k"])
    follow(spark, stored, folder)
    found = spark.read.parquet(f"{folder}/o").orderBy("k").collect()
    assert [r.k for r in found] == [2, 3] and found[0]["at"] is None
    assert found[1]["at"].isoformat() == "2024-01-02T03:04:05"


def view_of(spark, stored, sliced=False):
    by = F.length("g").cast("bigint") if sliced else None
    store = VersionedTable(spark, scratch(spark, "view"), by)
    return GroupView(
        store, stored, ["k"], ["g"], sums={"total": F.col("v")}, ranges={"v": F.col("v")},
        where=~F.col("_deleted"),
    )


@pytest.mark.parametrize("sliced", [True, False])
def test_view_equals_recomputation_after_every_change(spark, sliced):
    stored = table_of(spark, "source")
    view = view_of(spark, stored, sliced)
    batches = [
        FIRST,
        [(39, "a", 100), (1, "b", -5), (50, None, 3), (51, "new", None)],
        [(39, "a", 1), (51, "x", 0), (50, None, 4)],  # the greatest of a falls; 51 goes
        [(1, "x", 0), (2, "c", 2), (None, "x", 0)],
        [],
    ]
    for step, batch in enumerate(batches):
        changes = rows(spark, *batch).withColumn("step", F.lit(step))
        apply_changes_table(stored, changes, ["k"], ["step"], F.col("g") == "x")
        view.refresh()
        want = view.computed(stored.read())
        assert sorted(view.read().collect(), key=str) == sorted(want.select(*view.read().columns).collect(), key=str)
        assert view.position() == stored.latest()
    published = view.store.latest()
    assert view.refresh() == published  # nothing new


def test_view_starts_over_when_its_changes_are_gone(spark):
    stored = table_of(spark, "expired-source")
    view = view_of(spark, stored)
    for step in range(3):
        changes = rows(spark, (step, "a", step)).withColumn("step", F.lit(step))
        apply_changes_table(stored, changes, ["k"], ["step"])
        if step == 0:
            view.refresh()
    stored.expire(keep=1)
    view.refresh()
    assert [tuple(r) for r in view.read().select("g", "n", "total").collect()] == [("a", 3, 3)]


def test_view_refuses_sums_of_floating_point(spark):
    stored = table_of(spark, "floats")
    stored.publish(rows(spark, *FIRST))
    view = GroupView(table_of(spark, "f", sliced=False), stored, ["k"], ["g"], {"s": F.col("v").cast("double")})
    with pytest.raises(ValueError, match="floating point"):
        view.refresh()


def test_resync_finds_inserts_updates_and_deletes(spark):
    stored = table_of(spark, "resync")
    stored.publish(rows(spark, (1, "a", 1), (2, "b", 2), (None, "n", 3)))
    mine = digests(stored.read(), ["k"])
    assert resync(stored, mine, ["k"]).isEmpty()
    stored.publish(rows(spark, (1, "a", 1), (None, "n", None), (4, "d", 4)))
    assert listed(resync(stored, mine, ["k"])) == sorted(
        [(2, None, None, "delete", 2), (None, "n", None, "update_postimage", 2), (4, "d", 4, "insert", 2)], key=str
    )


def test_reader_behind_expired_versions(spark):
    stored = written(spark, "behind")
    reader, seen = FeedReader(stored, scratch(spark, "positions"), "r"), []
    state = digests(stored.read(1), ["k"]).collect()
    reader.files.write_text(f"{reader.folder}/{1:09d}", "")
    stored.expire(keep=1)
    with pytest.raises(LookupError):
        reader.run(["k"], lambda feed: seen.extend(feed.collect()))
    kept = spark.createDataFrame(state, "k int, _digest string")
    assert reader.run(["k"], lambda feed: seen.extend(feed.collect()), state=lambda: kept) == 4
    assert {(r.k, r["_change_type"]) for r in seen} == {
        (3, "update_postimage"), (50, "insert"), (60, "insert"), (61, "insert"), (None, "update_postimage"),
    }
    assert reader.run(["k"], lambda feed: seen.append("never")) == 4 and "never" not in seen
