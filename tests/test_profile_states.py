"""Merged profiles against profiles of the whole table, and what is read again."""

import datetime
import decimal

from pyspark.sql import functions as F

from tidegauge.operators.joins import dimension_join, hot_keys
from tidegauge.operators.profile import profile_dataframe
from tidegauge.plans.profile_states import ProfileStates
from tidegauge.plans.tables import upsert_table
from tidegauge.session import scratch
from tidegauge.sources.versions import VersionedTable

KINDS = (
    "k int, l bigint, d double, f float, m decimal(12,3), s string, long string, b boolean, day date, "
    "at timestamp, local timestamp_ntz, raw binary, items array<string>, pair struct<a:int,b:string>"
)


def rows(spark, ks, shift=0):
    def one(k):
        if k % 7 == 3:
            return (k, *[None] * 13)
        day = datetime.datetime(2024, 1, 1 + (k + shift) % 28, k % 24)
        double = [0.0, -0.0, float("nan"), 1e8 + k, 0.1][(k + shift) % 5]
        return (
            k, 2**60 + k % 3 + shift, double, double, decimal.Decimal(k % 11) / 8, "abc"[: k % 4] + str(shift),
            "x" * (40 + k % 30), k % 2 == 0, day.date(), day, day, bytes([k % 5]), ["a", None][: k % 3], (k % 4, "q"),
        )

    return spark.createDataFrame([one(k) for k in ks], KINDS)


def same(merged, whole):
    skip = ("profiled_at",)
    found, want = ({r.column_name: r.asDict() for r in p.collect()} for p in (merged, whole))
    assert set(found) == set(want)
    for name, row in want.items():
        for metric, value in row.items():
            if metric not in skip:
                got = found[name][metric]
                close = isinstance(value, float) and abs(got - value) <= 1e-6 * max(1, abs(value))
                assert close or str(got) == str(value), (name, metric, got, value)


def test_merged_profile_equals_profile_of_the_table(spark):
    stored = VersionedTable(spark, scratch(spark, "profiled"), F.floor(F.col("k") / 20))
    states = ProfileStates(stored, scratch(spark, "states"))
    stored.publish(rows(spark, range(100)))
    assert len(states.refresh()) == 5
    same(states.profile(), profile_dataframe(stored.read()))
    upsert_table(stored, rows(spark, [3, 41, 44, 200], shift=2), ["k"])
    # Three slices were written; the other four keep the states they have.
    assert sorted(f.split("=")[-1] for f in states.refresh()) == ["0", "10", "2"]
    assert states.refresh() == []
    same(states.profile(), profile_dataframe(stored.read()))
    same(states.profile(version=1), profile_dataframe(stored.read(1)))


def test_a_run_that_died_is_read_again(spark):
    stored = VersionedTable(spark, scratch(spark, "profiled"))
    states = ProfileStates(stored, scratch(spark, "states"))
    stored.publish(rows(spark, range(5)).select("k", "s"))
    rows(spark, range(2)).write.parquet(f"{states.path}/run=000001/states")
    assert states.refresh() == ["v=000001"] and list(states._runs()) == [2]
    same(states.profile(source_rid="r"), profile_dataframe(stored.read(), "r"))


def test_empty_table_and_a_changed_schema(spark):
    stored = VersionedTable(spark, scratch(spark, "profiled"), F.floor(F.col("k") / 2))
    states = ProfileStates(stored, scratch(spark, "states"))
    stored.publish(rows(spark, range(4)).limit(0))
    assert states.profile().collect() == []
    stored.publish(rows(spark, range(4)).select("k", "s"))
    same(states.profile(), profile_dataframe(stored.read()))
    wider = rows(spark, [1]).select("k", "s", "l")
    upsert_table(stored, wider, ["k"])
    same(states.profile(), profile_dataframe(stored.read()))


def test_only_hot_keys_are_salted(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 90).cast("int").alias("k"))
    assert hot_keys(facts, ["k"], 0.2) == [(1,)]
    path = scratch(spark, "facts")
    facts.write.parquet(path)
    stream = spark.readStream.schema(facts.schema).parquet(path)
    names = spark.range(90).selectExpr("CAST(id AS int) AS k", "concat('n', id) AS name")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = dimension_join(stream, names, ["k"], hot=[(1,)])
        assert joined.columns == ["k", "name"]
        out, folder = [], scratch(spark, "hot")
        query = joined.writeStream.option("checkpointLocation", folder).trigger(availableNow=True)
        query.foreachBatch(lambda df, _: out.extend(df.collect())).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(out) == 1000 and all(r.name == f"n{r.k}" for r in out)
