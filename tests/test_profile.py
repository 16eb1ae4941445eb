import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.plain_profile import plain_profile
from tidegauge.functions.columns import quoted
from tidegauge.operators import profile as profile_module
from tidegauge.operators.profile import PROFILE_SCHEMA, profile_dataframe, value_counts
from tidegauge.sources.datasets import read_districts


def by_column(df, **options):
    return {r["column_name"]: r.asDict() for r in profile_dataframe(df, **options).collect()}


def test_schema_and_tags(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    profile = profile_dataframe(df, "rid-1", "/some/path")
    assert [(f.name, f.dataType) for f in profile.schema] == [
        (f.name, f.dataType) for f in PROFILE_SCHEMA
    ]
    row = profile.first()
    assert (row["source_rid"], row["dataset_path"]) == ("rid-1", "/some/path")
    assert row["profiled_at"] is not None


def test_empty_input_gives_no_rows(spark):
    df = spark.createDataFrame([], "i int, s string, t timestamp, a array<int>")
    assert profile_dataframe(df).collect() == []
    assert profile_dataframe(spark.createDataFrame([()], T.StructType([]))).collect() == []


def test_all_null_columns(spark):
    schema = "i int, s string, d date, a array<int>"
    rows = by_column(spark.createDataFrame([(None,) * 4] * 3, schema))
    assert set(rows) == {"i", "s", "d", "a"}
    for row in rows.values():
        assert row["row_count"] == row["null_count"] == 3
        assert (row["null_pct"], row["distinct_count"], row["uniqueness_ratio"]) == (1.0, 0, 0.0)
        for metric in ("min_value", "max_value", "mean", "cv", "numeric_mode", "min_length"):
            assert row[metric] is None


@pytest.mark.parametrize("values, cv", [([-1, 1], None), ([-2, -4], -0.333333)])
def test_cv_of_zero_and_negative_means(spark, values, cv):
    assert by_column(spark.createDataFrame([(v,) for v in values], "x int"))["x"]["cv"] == cv


def test_mode_ties_go_to_the_lowest_value(spark):
    df = spark.createDataFrame([(v,) for v in (2, 1, 2, 1, None)], "x int")
    row = by_column(df)["x"]
    assert (row["numeric_mode"], row["null_count"], row["null_pct"]) == ("1", 1, 0.2)
    assert row["uniqueness_ratio"] == 0.5
    lowest = spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "x bigint")
    assert by_column(lowest)["x"]["numeric_mode"] == str(-(2**63))


def test_awkward_column_names(spark):
    names = ["count", "a.b", "a`b", "with space", "0"]
    rows = [tuple([v] * len(names)) for v in (5, 5, 9)]
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in names])
    found = by_column(spark.createDataFrame(rows, schema))
    assert set(found) == set(names)
    assert {r["numeric_mode"] for r in found.values()} == {"5"}
    assert quoted("a`b") == "`a``b`"


def test_decimals_are_numbers(spark):
    df = spark.createDataFrame(
        [(Decimal("9.00"), Decimal("1")), (Decimal("10.00"), Decimal("1"))],
        "x decimal(15,2), y decimal(5,0)",
    )
    row = by_column(df)["x"]
    assert (row["min_value"], row["max_value"], row["mean"]) == ("9.00", "10.00", 9.5)
    assert row["numeric_mode"] == "9.00"
    assert row["data_type"] == "decimal(15,2)"
    assert by_column(df)["y"]["distinct_count"] == 1


def test_float_corner_cases(spark):
    zeros = by_column(spark.createDataFrame([(-0.0,), (0.0,)], "x double"))["x"]
    assert zeros["distinct_count"] == 1
    nan = by_column(spark.createDataFrame([(math.nan,), (1.0,)], "x double"))["x"]
    assert nan["distinct_count"] == 2 and nan["null_count"] == 0
    assert math.isnan(nan["mean"]) and nan["numeric_mode"] == "1.0"
    short = by_column(spark.createDataFrame([(0.1,)], "x float"))["x"]
    assert (short["min_value"], short["numeric_mode"]) == ("0.1", "0.1")


def test_nested_and_binary_columns(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (array('null'), map('a', 1, 'b', 2), named_struct('x', 0.0D), X'00', true),
           (array(CAST(NULL AS STRING)), map('b', 2, 'a', 1), named_struct('x', -0.0D), X'00', NULL)
           AS t(a, m, s, b, f)"""
    )
    rows = by_column(df)
    assert {n: r["distinct_count"] for n, r in rows.items()} == {
        "a": 2, "m": 1, "s": 1, "b": 1, "f": 1,
    }
    assert rows["a"]["min_value"] == "[null]"
    assert (rows["f"]["min_value"], rows["f"]["null_count"]) == ("true", 1)


def test_range_of_dates_is_that_of_their_text(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (date'2024-01-02', date'-0044-03-15', timestamp'2024-01-01 00:00:00.5'),
           (date'2023-12-31', date'+12024-01-01', timestamp'2024-01-01 00:00:00'),
           (NULL, date'+102024-01-01', timestamp'2024-01-01 00:00:00.45') AS t(a, b, c)"""
    )
    text = df.select(*[F.col(c).cast("string") for c in df.columns])
    rows = by_column(df)
    for name in df.columns:
        want = text.agg(F.min(name), F.max(name)).first()
        assert (rows[name]["min_value"], rows[name]["max_value"]) == tuple(want)
    assert (rows["a"]["null_count"], rows["a"]["distinct_count"]) == (1, 2)


def test_long_texts_are_counted_whole(spark):
    base = "x" * 500
    texts = [base + "a", base + "b", base + "a", "short", base, None, "é" * 30]
    row = by_column(spark.createDataFrame([(t,) for t in texts], "t string"))["t"]
    assert row["distinct_count"] == 5
    assert (row["min_length"], row["max_length"]) == (5, 501)
    assert row["min_value"] == "short" and row["max_value"] == "é" * 30
    assert row["avg_length"] == round((501 * 3 + 5 + 500 + 30) / 6, 4)


def test_same_profile_for_any_order_and_partitioning(spark):
    df = spark.range(2000).selectExpr(
        "id % 7 AS k", "cast(id % 13 AS double) / 4 AS d", "concat('v', id % 5) AS s",
        "date_add(date'2024-01-01', cast(id % 40 AS int)) AS day", "id AS u",
    )
    skip = "profiled_at"
    want = sorted(profile_dataframe(df).drop(skip).collect())
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    assert sorted(profile_dataframe(shuffled).drop(skip).collect()) == want
    assert sorted(profile_dataframe(df, columns_per_scan=1).drop(skip).collect()) == want


def test_agrees_with_the_plain_form(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    kept = ["row_count", "null_count", "distinct_count", "min_value", "max_value", "numeric_mode"]
    found = by_column(df)
    for name, want in plain_profile(df).items():
        assert {k: found[name][k] for k in kept} == {k: want[k] for k in kept}
        for metric in ("mean", "stddev_pop", "cv", "avg_length"):
            assert found[name][metric] == (
                None if want[metric] is None else pytest.approx(want[metric], abs=2e-6)
            )


def test_plan_is_one_scan_per_lane_and_stays_in_generated_code(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = profile_dataframe(df)._jdf.queryExecution().executedPlan().toString()
    # numeric lanes (bigint, double) and text are scanned twice, timestamps once.
    assert plan.count("FileScan parquet") == 7
    assert "l_orderkey" in plan and "Python" not in plan
    assert "CartesianProduct" not in plan and "Window" not in plan


def test_value_counts(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (3, 2)], "a int, b int")
    found = {(r["position"], r["v"]): r["n"] for r in value_counts(df).collect()}
    assert found == {(0, 1): 2, (0, 3): 1, (1, 2): 2}


def test_district_file_with_crlf(spark, folder):
    lines = [
        "district_id,city,state_name,state_abbrev,region,division",
        "1,Aville,Ohio,OH,Midwest,East North Central",
        "2,Bville,Texas,TX,South,West South Central",
        "3,Aville,Texas,TX,South,West South Central",
    ]
    path = f"{folder}/districts.csv"
    with open(path, "w", newline="") as out:
        out.write("\r\n".join(lines) + "\r\n")
    rows = by_column(read_districts(spark, path))
    assert rows["district_id"]["mean"] == 2.0 and rows["district_id"]["numeric_mode"] == "1"
    assert (rows["city"]["distinct_count"], rows["city"]["uniqueness_ratio"]) == (2, 0.666667)
    assert (rows["division"]["min_length"], rows["division"]["max_length"]) == (18, 18)


def test_digest_bound_is_below_digest_length():
    assert profile_module.LONG_TEXT_BYTES < 64
