"""Golden values of the native expression helpers."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.functions import labels, numeric, time as tf_time


def _one(spark, col, data=None, schema="x double"):
    df = spark.createDataFrame(data or [(1.0,)], schema)
    return [r[0] for r in df.select(col.alias("v")).collect()]


def test_ieee_div(spark):
    rows = [(1.0, 0.0), (-2.0, 0.0), (0.0, 0.0), (float("nan"), 0.0), (None, 0.0),
            (6.0, 3.0), (1.0, None), (1.0, -0.0), (-1.0, -0.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(numeric.ieee_div(F.col("a"), F.col("b"))).collect()]
    assert got[0] == math.inf and got[1] == -math.inf
    assert math.isnan(got[2]) and math.isnan(got[3])
    assert got[4] is None and got[5] == 2.0 and got[6] is None
    assert got[7] == -math.inf and got[8] == math.inf          # signed zero divisor


def test_null_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.null_div(F.col("a"), F.col("b"))).collect()] == [None, 2.0]


def test_ieee_ln(spark):
    got = _one(spark, numeric.ieee_ln(F.col("x")), [(0.0,), (-1.0,), (math.e,), (None,)])
    assert got[0] == -math.inf and math.isnan(got[1]) and got[2] == pytest.approx(1.0)
    assert got[3] is None


def test_norm_cdf_accuracy(spark):
    xs = [i / 8.0 for i in range(-320, 321)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", numeric.norm_cdf(F.col("x")).alias("n"),
                    numeric.norm_cdf(-F.col("x")).alias("m")).collect()
    for r in got:
        exact = 0.5 * math.erfc(-r.x / math.sqrt(2.0))
        assert abs(r.n - exact) < 1e-14
        assert r.n + r.m == pytest.approx(1.0, abs=1e-15)   # N(x) + N(-x) = 1


def test_norm_cdf_special(spark):
    got = _one(spark, numeric.norm_cdf(F.col("x")),
               [(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (0.0,)])
    assert got[0] == 1.0 and got[1] == 0.0 and math.isnan(got[2]) and got[3] is None
    assert got[4] == pytest.approx(0.5)


def test_dead_band(spark):
    got = _one(spark, numeric.dead_band_funding(F.col("x")),
               [(0.0001,), (-0.0001,), (0.001,), (-0.001,), (None,)])
    assert got[0] == 0.0 and got[1] == 0.0
    assert got[2] == pytest.approx((0.001 - 0.00025) / 480)
    assert got[3] == pytest.approx((-0.001 + 0.00025) / 480)
    assert got[4] == 0.0                                     # NULL premium -> 0 funding


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 900000),
                                 datetime(2024, 1, 1, 0, 0, 1, 100000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(tf_time.seconds_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_bucket_keeps_ntz(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 59, 59, 999999),)], "t timestamp_ntz")
    out = df.select(tf_time.bucket(df, "t", "hour").alias("h"))
    assert out.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert out.first()[0] == datetime(2024, 1, 1, 10, 0)


def test_minute_edges(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 1),), (datetime(2024, 1, 1, 0, 1, 0, 1),)],
                               "t timestamp_ntz")
    dt = df.schema["t"].dataType
    got = df.select(tf_time.ceil_minute(F.col("t"), dt), tf_time.last_minute_before(F.col("t"), dt)).collect()
    assert got[0][0] == datetime(2024, 1, 1, 0, 1) and got[0][1] == datetime(2024, 1, 1, 0, 0)
    assert got[1][0] == datetime(2024, 1, 1, 0, 2) and got[1][1] == datetime(2024, 1, 1, 0, 1)


def test_labels_right_closed_and_else(spark):
    xs = [(0.2,), (0.2000001,), (0.8,), (0.9,), (None,), (float("nan"),)]
    got = _one(spark, labels.delta_bucket(F.col("x")), xs)
    assert got == ["0-0.2", "0.2-0.4", "0.6-0.8", "0.8-1", "0.8-1", "0.8-1"]
    got = _one(spark, labels.futures_expiry_bucket(F.col("x")), [(-1.0,), (0.0383,), (0.6,), (None,)])
    assert got == ["2w", "2w", "12m", "12m"]
    got = _one(spark, labels.options_expiry_bucket(F.col("x")), [(0.0,), (0.01,), (0.3,)])
    assert got == ["3d", "1w", "6m"]
