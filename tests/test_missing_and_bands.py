"""Edge table tests for the missing-value contract (M1–M9) and the band rules."""

import math

import pytest
from pyspark.sql import functions as F

from colforge.functions import bands, targets
from colforge.functions.missing import fill_int, ne_keep_missing, not_in_keep_missing, to_double

EDGES = [None, float("nan"), -1.0, 0.0, 2.5, 2.5000001, 3.0, 3.2499, 3.25, 3.2501, 3.5, 3.5000001,
         4.5, 9.5, 9.5000001, 9.75, 9.7500001, 12.0]


def half_rule(x):
    if x is None or math.isnan(x):
        return 0.0
    if 3 <= x < 3.25:
        return 3.0
    for c in bands.HALF_BAND_CENTRES:
        if c - 0.25 < x < c + 0.25:
            return float(c)
    return 10.0 if x > 9.75 else 0.0


def unit_rule(x):
    if x is None or math.isnan(x):
        return 0
    for k in bands.UNIT_BAND_CENTRES:
        if k - 0.5 < x <= k + 0.5:
            return k
    return 10 if x > 9.5 else 0


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(EDGES)], "i int, x double")


def test_band_half_edges(edges):
    got = {r.i: r.b for r in edges.select("i", bands.band_half("x").alias("b")).collect()}
    for i, x in enumerate(EDGES):
        assert got[i] == half_rule(x), (x, got[i])


def test_band_unit_edges(edges):
    got = {r.i: r.b for r in edges.select("i", bands.band_unit("x").alias("b")).collect()}
    for i, x in enumerate(EDGES):
        assert got[i] == unit_rule(x), (x, got[i])


def test_open_edges_band_to_zero(spark):
    df = spark.createDataFrame([(x,) for x in (3.25, 3.75, 5.25, 9.75)], "x double")
    assert {r.b for r in df.select(bands.band_half("x").alias("b")).collect()} == {0.0}


def test_text_coercion(spark):
    df = spark.createDataFrame([("",), ("NA",), ("abc",), (" 1.5 ",), ("1e3",), ("nan",), (None,)], "t string")
    got = [r.v for r in df.select(to_double("t").alias("v")).collect()]
    assert got == [None, None, None, 1.5, 1000.0, None, None]


def test_not_equal_keeps_missing(spark):
    df = spark.createDataFrame([(3.5,), (3.7,), (None,), (4.0,)], "x double")
    assert df.where(ne_keep_missing("x", 3.5)).count() == 3
    assert df.where(not_in_keep_missing("x", [3.5, 3.7])).count() == 2


def test_fill_int_truncates(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (None,), (float("nan"),)], "x double")
    assert [r.v for r in df.select(fill_int("x").alias("v")).collect()] == [2, -2, 0, 0]


def test_match_result_missing(spark):
    df = spark.createDataFrame([(1.0,), (-2.0,), (0.0,), (None,), (float("nan"),)], "d double")
    assert [r.r for r in df.select(targets.match_result("d").alias("r")).collect()] == [1, 2, 0, -1, -1]


def test_trend_and_flags_missing_to_zero(spark):
    df = spark.createDataFrame([(None, 5.0)], "a double, b double")
    r = df.select(targets.trend("a", "b").alias("t"), targets.at_or_above("a", "b").alias("o")).first()
    assert (r.t, r.o) == (0, 0)


def test_distance_flag_float_edges(spark):
    df = spark.createDataFrame([(7.0, 6.8), (0.3, 0.1)], "a double, b double")
    got = [r.f for r in df.select(targets.distance_flags("a", "b", "d")["d02"].alias("f")).collect()]
    assert got == [1, 0]


def test_nan_counts_as_missing_in_distinct(spark):
    from colforge.operators.profile import distinct_counts
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-0.0,), (0.0,)], "x double")
    assert distinct_counts(df).first().nunique == 2


def test_corr_constant_column_is_null(spark):
    from colforge.operators.profile import pairwise_corr
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert pairwise_corr(df, ["a", "b"]).first().corr is None


def test_row_mean_nonzero(spark):
    from colforge.functions.columns import row_mean_nonzero
    df = spark.createDataFrame([(0.0, None, 4.0), (0.0, 0.0, None)], "a double, b double, c double")
    got = [r.m for r in df.select(row_mean_nonzero(["a", "b", "c"]).alias("m")).collect()]
    assert got == [4.0, None]


def test_cleaning_report_attributes_first_failure(spark):
    from colforge.operators.clean import cleaning_report
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 0), (None, 1)], "a int, b int")
    rep = {r.step: (r.rows_removed, r.rows_after) for r in
           cleaning_report(df, [("a", F.col("a") == 1), ("b", F.col("b") == 1)]).collect()}
    assert rep == {"a": (3, 2), "b": (1, 1), "total": (4, 1)}
