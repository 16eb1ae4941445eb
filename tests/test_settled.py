"""Rows that wait for the watermark, late and unreadable rows, and state read as tables."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import Landing, at
from tidegauge.operators.parsing import accepted, error_counts, parsed, rejected
from tidegauge.session import scratch
from tidegauge.sources.files import SharedFiles
from tidegauge.streaming.exact import exactly_deduplicated
from tidegauge.streaming.flows import run_flow
from tidegauge.streaming.late import LATE, REJECTED, split_late, split_rejects, split_rows

EVENT = "event_time timestamp, k int, n int"


def plain_kept(rows, within, upto):
    """First rows of runs, by time; ``upto`` is where the watermark stands."""
    kept, last = [], {}
    for t, k, n in sorted(rows, key=lambda r: r[0]):
        if t <= upto and (k not in last or t - last[k] > within):
            kept.append((t, k))
            last[k] = t
    return sorted(kept, key=str)


def exact(spark, batches, delay="30 minutes", within="10 minutes"):
    """Each batch is a file; all are streamed one by one on one checkpoint."""
    landing, folder = Landing(spark), scratch(spark, "exact-test")
    for batch in batches:
        landing.file(*batch, schema=EVENT)
    kept = exactly_deduplicated(landing.stream(max_files=1), "event_time", delay, ["k"], within)
    run = run_flow(kept, f"{folder}/c", "exact", path=f"{folder}/o")
    rows = spark.read.schema(EVENT).parquet(f"{folder}/o").collect()
    return sorted(((r.event_time, r.k) for r in rows), key=str), run


def test_rows_further_apart_are_never_merged_within_a_batch(spark):
    times = ["12:00", "12:05", "12:10", "12:11", "12:30", "12:40", "12:41", "20:00"]
    rows = [(at(t), None, i) for i, t in enumerate(times)]
    got, _ = exact(spark, [rows])
    assert [t.strftime("%H:%M") for t, _ in got] == ["12:00", "12:11", "12:30", "12:41"]


def test_exact_whatever_the_batches(spark):
    rng = random.Random(11)
    start = at("00:00")
    rows = [(start + timedelta(seconds=rng.randrange(12 * 3600)), rng.choice([1, 1, 1, 2, None]), i) for i in range(150)]
    rows += [(r[0], r[1], 1000 + i) for i, r in enumerate(rows[::10])]
    ordered = sorted(rows, key=lambda r: r[0])
    jittered = sorted(rows, key=lambda r: r[0] + timedelta(minutes=rng.randrange(25)))
    want = plain_kept(rows, timedelta(minutes=10), max(r[0] for r in rows) - timedelta(minutes=30))
    for arrival, size in ((ordered, len(rows)), (jittered, 40)):
        got, run = exact(spark, [arrival[i : i + size] for i in range(0, len(arrival), size)])
        assert run.dropped_rows == 0 and got == want


def test_waiting_rows_are_not_in_python_state(spark):
    rows = [(at("12:00") + timedelta(minutes=i), i % 3, i) for i in range(150)]
    got, run = exact(spark, [rows])
    assert got == plain_kept(rows, timedelta(minutes=10), rows[-1][0] - timedelta(minutes=30))
    ops = [op for p in run.progress for op in p["stateOperators"]]
    held = {name: max(op["numRowsTotal"] for op in ops if op["operatorName"] == name) for name in {op["operatorName"] for op in ops}}
    # An entry per key and its timer; every row would be 150 and more.
    assert held["transformWithStateInPySparkExec"] <= 6 and held["stateStoreSave"] == 150


@pytest.mark.parametrize(
    "kind, first, same, other",
    [
        ("double", 0.0, -0.0, 1.5),
        ("array<string>", ["a", None], ["a", None], ["a"]),
        ("binary", b"1", b"1", None),
        ("string", "", "", None),
    ],
)
def test_keys_of_any_type(spark, kind, first, same, other):
    schema = f"event_time timestamp, k {kind}, l string, note map<string,int>, n int"
    rows = [
        (at("12:00"), first, "x", {"a": 1}, 1),
        (at("12:05"), same, "x", {"b": 2}, 2),
        (at("12:05"), other, "x", None, 3),
        (at("12:11"), same, "x", {}, 4),
        (at("12:11"), first, None, None, 5),
        (at("20:00"), first, "x", None, 6),
    ]
    folder = scratch(spark, "exact-keys")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/i")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/i")
    kept = exactly_deduplicated(stream, "event_time", "30 minutes", ["k", "l"], "10 minutes")
    run_flow(kept, f"{folder}/c", "exact", path=f"{folder}/o")
    got = spark.read.parquet(f"{folder}/o")
    assert got.columns == ["event_time", "k", "l", "note", "n"]
    found = {r.n: (r.k if r.k is None or kind != "binary" else bytes(r.k), r.note) for r in got.collect()}
    assert found == {1: (first, {"a": 1}), 3: (other, None), 4: (same, {}), 5: (first, None)}


@pytest.fixture
def aside(spark):
    landing, folder = Landing(spark), scratch(spark, "aside")
    landing.file("12:00", "13:00").file("12:49", "12:50", "12:51", "14:00").file("13:55", "13:00")

    def run():
        return split_late(landing.stream(max_files=1), "event_time", "10 minutes", f"{folder}/c", f"{folder}/o")

    return run, folder


def test_late_rows_are_put_aside_once(spark, aside):
    run, folder = aside

    def rows(late=None):
        found = split_rows(spark, f"{folder}/o", LATE, late).collect()
        return sorted((r.batch, r.event_time.strftime("%H:%M")) for r in found)

    run()
    assert rows(True) == [(1, "12:49"), (1, "12:50"), (2, "13:00")]
    whole = rows()
    assert len(whole) == 8
    # The last batch was written and its commit lost: the engine repeats it.
    files = SharedFiles(spark)
    last = max(int(n) for n in files.children(f"{folder}/c/commits") if n.isdigit())
    files.delete(f"{folder}/c/commits/{last}")
    files.delete(f"{folder}/c/commits/.{last}.crc")
    run()
    assert rows() == whole


CASTS = {"casts": {"a": "int"}, "json": {"j": "x INT, y STRING"}, "required": ["id"]}
RAW = [
    (1, "7", '{"x": 1, "y": "p"}'),
    (2, "seven", '{"x": 2}'),
    (3, None, None),
    (None, "8", '{"x": "no"}'),
    (5, "9999999999", "{"),
    (6, " 4 ", "[]"),
    (6, "", ""),
]


def test_accepted_and_rejected_are_all_rows(spark):
    df = spark.createDataFrame(RAW, "id int, a string, j string")
    rows = parsed(df, **CASTS)
    good = sorted((r.id, r.a, r.j and tuple(r.j)) for r in accepted(rows).collect())
    assert good == [(1, 7, (1, "p")), (3, None, None)]
    bad = rejected(rows)
    assert bad.columns == [*df.columns, "_errors"] and bad.schema["a"].dataType.simpleString() == "string"
    assert {tuple(r)[:3] for r in bad.collect()} == {r for r in RAW if r[0] not in (1, 3)}
    assert len(good) + bad.count() == len(RAW)
    counted = {r.error: r.n for r in error_counts(rows).collect()}
    assert counted["id: missing"] == 1 and counted["a: not int"] == 3 and counted["j: not x INT, y STRING"] == 4


def test_quarantine_of_a_stream(spark):
    path, folder = scratch(spark, "raw"), scratch(spark, "quarantine")
    df = spark.createDataFrame(RAW, "id int, a string, j string")
    df.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    split_rejects(stream, f"{folder}/c", f"{folder}/o", **CASTS)
    rows = split_rows(spark, f"{folder}/o", REJECTED)
    want = parsed(df, **CASTS)
    assert rows.filter(REJECTED).count() == rejected(want).count()
    assert rows.count() == len(RAW)
    assert rows.filter(F.col(REJECTED) != F.col("_raw").isNotNull()).isEmpty()
