import random
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegauge.functions.watermarks import jdbc_predicate, later, order_key, since
from tidegauge.operators.changes import (
    UpstreamChangeError,
    apply_changes,
    catch_up,
    change_feed,
    latest_per_key,
    live_rows,
    upsert,
)
from tidegauge.plans import ingest as ingest_module
from tidegauge.plans.ingest import ingest, ingest_source, read_watermark
from tidegauge.plans.tables import merge_into, read_changes, upsert_table
from tidegauge.session import scratch
from tidegauge.sources.increments import (
    INGESTED_AT,
    SOURCE_SCHEMA,
    SOURCE_VALUE,
    Source,
    active_sources,
    extract_increment,
    jdbc_options,
)
from tidegauge.sources.versions import VersionedTable

SOURCE = Source("sys", "t", ("id",), "changed", "timestamp", "t")
SCHEMA = "id int, changed timestamp, v string"


def at(hour, minute=0):
    return datetime(2024, 5, 1, hour, minute)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def tables(spark):
    return VersionedTable(spark, scratch(spark, "target")), VersionedTable(spark, scratch(spark, "wm"))


# -- watermarks --------------------------------------------------------------------------------


def test_watermarks_compare_by_type():
    assert later("9", "10", "bigint") == "10"
    assert later("10", None, "bigint") == "10" and later(None, "3", "epoch_ms") == "3"
    assert later("2024-01-02", "2024-01-01", "date") == "2024-01-02"
    assert later("2024-01-01 00:00:00.5", "2024-01-01 00:00:00", "timestamp").endswith(".5")
    with pytest.raises(ValueError):
        later("1", "2", "text")


def test_predicates_reach_the_parquet_scan(spark, folder):
    df = spark.createDataFrame([(1, at(1), date(2024, 5, 1), 5)], "i int, t timestamp, d date, e bigint")
    df.write.parquet(f"{folder}/p")
    stored = spark.read.parquet(f"{folder}/p")
    cases = [("t", "timestamp", "2024-05-01 00:10:00"), ("d", "date", "2024-04-30"),
             ("e", "epoch_ms", "4"), ("i", "bigint", "0")]
    for column, kind, value in cases:
        filtered = stored.filter(since(stored, column, kind, value, 30))
        plan = filtered._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThan({column}," in plan, plan
        assert filtered.count() == 1


def test_lookback_by_type(spark):
    df = spark.createDataFrame([(at(11, 40), 700_000)], "t timestamp, e bigint")
    assert df.filter(since(df, "t", "timestamp", "2024-05-01 12:00:00", 30)).count() == 1
    assert df.filter(since(df, "t", "timestamp", "2024-05-01 12:00:00", 20)).count() == 0
    assert df.filter(since(df, "e", "epoch_ms", "2000000", 30)).count() == 1
    assert df.filter(since(df, "e", "bigint", "2000000", 30)).count() == 0
    assert jdbc_predicate("t", "timestamp", "2024-05-01 12:00:00", 30) == "t > TIMESTAMP '2024-05-01 11:30:00'"
    assert jdbc_predicate("d", "date", "2024-05-01", 30) == "d > DATE '2024-04-30'"
    assert jdbc_predicate("d", "date", "2024-05-03", 2 * 1440 + 5) == "d > DATE '2024-04-30'"
    assert jdbc_predicate("e", "epoch_ms", "2000000", 30) == "e > 200000"
    assert jdbc_predicate("n", "bigint", "7", 30) == "n > 7"


def test_jdbc_options():
    options = jdbc_options("jdbc:x", SOURCE, "2024-05-01 12:00:00", "id", 0, 100, 8)
    assert options["dbtable"] == "(SELECT * FROM t WHERE changed > TIMESTAMP '2024-05-01 11:30:00') t"
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "8")
    assert "IS NOT NULL" in jdbc_options("jdbc:x", SOURCE, None)["dbtable"]
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", SOURCE, None, partitions=4)


def test_extract_adds_lineage_and_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, at(1), "a"), (2, None, "b")], SCHEMA)
    rows = extract_increment(df, "changed", "timestamp", None)
    assert rows.columns == ["id", "changed", "v", INGESTED_AT, SOURCE_VALUE]
    found = rows.collect()
    assert [r["id"] for r in found] == [1]
    assert found[0][SOURCE_VALUE] == "2024-05-01 01:00:00.000000+00:00"


def test_order_key_orders_by_time_then_sequence(spark):
    df = spark.createDataFrame([(at(1), 5), (at(1), 40), (at(2), 1)], "t timestamp, s bigint")
    keys = [r[0] for r in df.select(order_key(F.col("t"), F.col("s"))).collect()]
    assert keys == sorted(keys) and len(set(keys)) == 3


# -- ingestion ---------------------------------------------------------------------------------


def test_runs_follow_the_watermark(spark):
    target, control = tables(spark)
    first = spark.createDataFrame([(1, at(10), "a"), (2, at(12), "b"), (3, None, "n")], SCHEMA)
    status = ingest_source(SOURCE, first, target, control)
    assert (status.rows_processed, status.rows_without_watermark) == (2, 1)
    mark = status.watermark_value
    assert mark.startswith("2024-05-01 12:00:00")

    again = ingest_source(SOURCE, first, target, control)
    assert again.watermark_value == mark and again.rows_processed == 1
    nothing = ingest_source(SOURCE, first.filter("id = 1"), target, control)
    assert (nothing.rows_processed, nothing.watermark_value) == (0, mark)

    late = spark.createDataFrame(
        [(4, at(11, 45), "inside"), (5, at(11, 15), "outside"), (2, at(13), "b2")], SCHEMA
    )
    ingest_source(SOURCE, late, target, control)
    found = {r["id"]: r["v"] for r in target.read().collect()}
    assert found == {1: "a", 2: "b2", 4: "inside"}

    bronze = first.unionByName(late).filter(F.col("changed").isNotNull())
    caught_up = catch_up(bronze, target.read().select("id", "changed", "v"), ["id"], ["changed"])
    assert {r["id"]: r["v"] for r in caught_up.collect()} == {**found, 5: "outside"}


def test_changed_logic_falls_back_to_a_full_load(spark):
    target, control = tables(spark)
    df = spark.createDataFrame([(1, at(1), "a"), (2, at(9), "b")], SCHEMA)
    for logic, value in (("1", "v"), ("2", "upper(v)"), ("2", "'unused'")):
        source_rows = df.selectExpr("id", "changed", f"{value} AS v")
        ingest_source(SOURCE, source_rows, target, control, logic=logic)
    assert {r["id"]: r["v"] for r in target.read().collect()} == {1: "A", 2: "unused"}
    assert target.version().logic == "2"


def test_target_without_control_row_is_loaded_again(spark):
    target, control = tables(spark)
    df = spark.createDataFrame([(1, at(1), "a")], SCHEMA)
    ingest_source(SOURCE, df, target, control)
    fresh_control = VersionedTable(spark, scratch(spark, "wm"))
    status = ingest_source(SOURCE, df.union(df), target, fresh_control)
    assert status.rows_processed == 2 and target.read().count() == 1


def test_highest_sequence_wins_within_one_extract(spark):
    target, control = tables(spark)
    df = spark.createDataFrame([(1, at(3), "new"), (1, at(1), "old"), (1, at(2), "mid")], SCHEMA)
    ingest_source(SOURCE, df, target, control)
    assert [r["v"] for r in target.read().collect()] == ["new"]


def test_text_watermarks_of_numbers(spark):
    target, control = tables(spark)
    source = Source("sys", "n", ("id",), "id", "bigint", "n")
    ingest_source(source, spark.createDataFrame([(9,)], "id bigint"), target, control)
    status = ingest_source(source, spark.createDataFrame([(9,), (10,)], "id bigint"), target, control)
    assert (status.watermark_value, status.rows_processed) == ("10", 1)
    assert read_watermark(control.read(), "sys", "n") == "10"


def test_crash_between_target_and_watermark(spark, monkeypatch):
    df = spark.createDataFrame([(i, at(i), f"v{i}") for i in range(1, 6)], SCHEMA)
    clean, clean_control = tables(spark)
    ingest_source(SOURCE, df, clean, clean_control)

    target, control = tables(spark)
    with monkeypatch.context() as broken:
        def crash(*args, **kwargs):
            raise RuntimeError("stopped")
        broken.setattr(ingest_module, "commit_watermark", crash)
        with pytest.raises(RuntimeError):
            ingest_source(SOURCE, df, target, control)
    assert target.versions() and not control.versions()
    ingest_source(SOURCE, df, target, control)
    plain = ["id", "changed", "v"]
    assert rows_of(target.read().select(*plain)) == rows_of(clean.read().select(*plain))


def test_ingest_isolates_sources(spark):
    registry = spark.createDataFrame(
        [
            ("s", "good", "id", "changed", "timestamp", None, None, None),
            ("s", "bad", "id", "changed", "timestamp", None, None, True),
            ("s", "odd type", "id", "changed", "text", None, None, True),
            ("s", "off", "id", "changed", "timestamp", None, None, False),
        ],
        SOURCE_SCHEMA,
    )
    defaults = {r["source_table"]: r for r in active_sources(registry)}
    assert set(defaults) == {"good", "bad", "odd type"}
    assert (defaults["good"]["lookback_minutes"], defaults["good"]["target_table"]) == (30, "good")
    target, control = tables(spark)

    def read(source):
        if source.source_table == "bad":
            raise OSError("no connection")
        return spark.createDataFrame([(1, at(1), "a")], SCHEMA)

    found = ingest(registry, read, lambda s: target, control).collect()
    assert {r["source_table"]: r["status"] for r in found} == {
        "good": "success", "bad": "failed", "odd type": "failed",
    }
    # A first run that fails is recorded too, without a watermark.
    stored = {r["source_table"]: (r["last_run_status"], r["watermark_value"]) for r in control.read().collect()}
    assert set(stored) == {"good", "bad"} and stored["bad"] == ("failed", "")
    assert read_watermark(control.read(), "s", "bad") is None


def test_a_full_load_reads_its_source_once(spark):
    folder, (target, control) = scratch(spark, "once"), tables(spark)
    spark.createDataFrame([(1, at(1), "a"), (2, None, "b"), (1, at(2), "c")], SCHEMA).write.parquet(folder)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.read.schema(SCHEMA).parquet(folder).mapInArrow(counted, SCHEMA)
    one = Source("s", "t", ("id",), "changed", "timestamp", "t")
    status = ingest_source(one, source, target, control)
    assert (status.rows_processed, status.rows_without_watermark) == (2, 1)
    assert [r[2] for r in target.read().collect()] == ["c"] and seen.value == 3


# -- changes -----------------------------------------------------------------------------------


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    once = upsert(target, updates, ["k"])
    assert {r["k"]: r["v"] for r in once.collect()} == {1: "a", 2: "B", 3: "C", None: "N"}
    assert sorted(upsert(once, updates, ["k"]).collect(), key=str) == sorted(once.collect(), key=str)


CHANGES = [
    (1, 10, 1, "a", "put"), (1, 10, 2, "b", "put"), (1, 9, 9, "old", "put"),
    (2, 5, 1, "x", "put"), (2, 6, 1, None, "del"), (2, 5, 9, "y", "put"),
    (3, 1, 1, None, "del"), (3, 2, 1, "back", "put"),
]
CHANGE_SCHEMA = "k int, ts int, seq int, v string, op string"


def test_changes_in_any_order_and_batching(spark):
    rng = random.Random(5)
    want = {1: "b", 3: "back"}
    for _ in range(4):
        shuffled = rng.sample(CHANGES, len(CHANGES))
        cut = rng.randrange(1, len(CHANGES))
        target = None
        for batch in (shuffled[:cut], shuffled[cut:], shuffled[:cut]):
            changes = spark.createDataFrame(batch, CHANGE_SCHEMA)
            target = apply_changes(target, changes, ["k"], ["ts", "seq"], F.col("op") == "del")
        assert {r["k"]: r["v"] for r in live_rows(target).collect()} == want
        assert target.filter("_deleted").count() == 1


def test_exact_ties_do_not_depend_on_order(spark):
    rows = [(1, 1, chr(97 + i)) for i in range(8)]
    results = set()
    for seed in range(3):
        df = spark.createDataFrame(random.Random(seed).sample(rows, 8), "k int, s int, v string")
        results.add(latest_per_key(df.repartition(3), ["k"], ["s"]).first()["v"])
    assert len(results) == 1


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS s", "id AS v")
    plan = latest_per_key(df, ["k"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_change_feed_images(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k int, v string")
    found = change_feed(before.union(spark.createDataFrame([(9, "z")], "k int, v string")), after, ["k"])
    assert rows_of(found) == [
        (2, "B", "update_postimage"), (2, "b", "update_preimage"), (4, "d", "insert"), (9, "z", "delete"),
    ]


def test_change_policies(spark):
    table = VersionedTable(spark, scratch(spark, "t"), F.floor(F.col("k") / 10))
    table.publish(spark.createDataFrame([(1, "a"), (11, "b")], "k int, v string"))
    upsert_table(table, spark.createDataFrame([(21, "c")], "k int, v string"), ["k"])
    upsert_table(table, spark.createDataFrame([(11, "B"), (22, "d")], "k int, v string"), ["k"])
    feed = read_changes(table, ["k"], 1, on_change="feed")
    assert rows_of(feed.select("k", "_change_type", "_commit_version")) == [
        (11, "update_postimage", 3), (11, "update_preimage", 3), (21, "insert", 2), (22, "insert", 3),
    ]
    assert [r["k"] for r in read_changes(table, ["k"], 1, on_change="skip").collect()] == [21]
    assert [r["k"] for r in read_changes(table, ["k"], 1, upto=2).collect()] == [21]
    with pytest.raises(UpstreamChangeError):
        read_changes(table, ["k"], 1)
    assert read_changes(table, ["k"], 3).count() == 0


# -- versions ----------------------------------------------------------------------------------


def test_upsert_rewrites_touched_slices_only(spark):
    table = VersionedTable(spark, scratch(spark, "t"), F.floor(F.col("k") / 10))
    table.publish(spark.range(40).selectExpr("id AS k", "'a' AS v"))
    upsert_table(table, spark.createDataFrame([(15, "B"), (41, "N")], "k bigint, v string"), ["k"])
    folders = table.version().folders
    assert {k: f.split("/")[0] for k, f in folders.items()} == {
        "0": "v=000001", "1": "v=000002", "2": "v=000001", "3": "v=000001", "4": "v=000002",
    }
    assert table.read().count() == 41 and table.previous().count() == 40
    assert table.read().filter("v <> 'a'").count() == 2
    table.publish(spark.range(3).selectExpr("id AS k", "'z' AS v"))
    table.expire(keep=1)
    assert table.versions() == [3] and table.read().count() == 3


def test_expire_keeps_folders_in_use(spark):
    table = VersionedTable(spark, scratch(spark, "t"), F.floor(F.col("k") / 10))
    table.publish(spark.range(20).selectExpr("id AS k", "'a' AS v"))
    for value in ("b", "c"):
        upsert_table(table, spark.createDataFrame([(15, value)], "k bigint, v string"), ["k"])
    dropped = table.expire(keep=1)
    assert dropped and table.read().count() == 20
    assert table.read().filter("v = 'c'").count() == 1


def test_unfinished_versions_are_not_seen(spark):
    table = VersionedTable(spark, scratch(spark, "t"))
    table.publish(spark.range(2))
    spark.range(5).write.parquet(f"{table.path}/v=000002")  # a writer that died before its marker
    assert table.read().count() == 2
    assert table.publish(spark.range(7)) == 3 and table.previous().count() == 2
    with pytest.raises(LookupError):
        table.read(2)


def test_merge_is_refused_by_plain_parquet(spark):
    spark.range(2).selectExpr("id", "'a' AS v").write.mode("overwrite").saveAsTable("plain_table")
    with pytest.raises(PySparkException):
        merge_into(spark, "plain_table", spark.range(1).selectExpr("id", "'b' AS v"), ["id"])
    spark.sql("DROP TABLE plain_table")
