"""The reference's scalar vectors, run as DataFrame expressions."""

import math

import pytest
from pyspark.sql import functions as F

from stratus.functions import (
    compass_degrees, f_to_c, in_to_mm, inhg_to_hpa, mph_to_kmh, parse_measure, sanitize_frame,
)
from stratus.schema import UNIFIED_COLUMNS


def one(spark, expr, value, dtype="double"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("f,c", [(32.0, 0.0), (212.0, 100.0), (-40.0, -40.0), (68.0, 20.0), (57.7, 14.28)])
def test_f_to_c(spark, f, c):
    assert one(spark, f_to_c, f) == c


@pytest.mark.parametrize("m,k", [(0.0, 0.0), (60.0, 96.56), (1.0, 1.61)])
def test_mph(spark, m, k):
    assert one(spark, mph_to_kmh, m) == k


def test_inhg(spark):
    assert abs(one(spark, inhg_to_hpa, 29.92) - 1013.25) < 0.1
    assert one(spark, inhg_to_hpa, 0.0) == 0.0


def test_inches(spark):
    assert one(spark, in_to_mm, 1.0) == 25.4
    assert one(spark, in_to_mm, 0.0) == 0.0


@pytest.mark.parametrize("raw,val", [
    ("57.7", 57.7), ("100", 100.0), ("57.7 \u00a0\u00b0F", 57.7), ("57,7", 57.7),
    (None, None), ("", None), ("--", None), ("N/A", None), ("NaN", None),
    ("<0.1 in", 0.1), ("57.7°F", None), ("1,013.25 hPa", None),
])
def test_parse_measure(spark, raw, val):
    assert one(spark, parse_measure, raw, "string") == val


@pytest.mark.parametrize("txt,deg", [
    ("North", 0.0), ("South", 180.0), ("East", 90.0), ("NNE", 22.5),
    (None, None), ("", None), ("Unknown", None), (" NNE ", 22.5), ("north", None),
])
def test_compass(spark, txt, deg):
    assert one(spark, compass_degrees, txt, "string") == deg


def test_sanitize_scalars_and_nested(spark):
    df = spark.createDataFrame(
        [(float("nan"), float("inf"), float("-inf"), 42.5, {"a": float("nan"), "b": 42.0},
          [float("nan"), 1.0, None], 3.14, 2**62)],
        "a double, b double, c double, d double, m map<string,double>, l array<double>, e double, big bigint")
    r = sanitize_frame(df).first()
    assert r["a"] is None and r["b"] is None and r["c"] is None
    assert r["d"] == 42.5 and r["e"] == 3.14
    assert r["m"] == {"a": None, "b": 42.0}
    assert r["l"] == [None, 1.0, None]
    assert r["big"] == 2**62  # 64-bit integers are kept


def test_sanitize_struct(spark):
    df = spark.createDataFrame([((float("nan"), "x"),)], "s struct<v: double, t: string>")
    r = sanitize_frame(df).first()
    assert r["s"]["v"] is None and r["s"]["t"] == "x"


def test_schema_shape():
    assert len(UNIFIED_COLUMNS) == 23
    for c in ["source", "station_id", "timestamp", "temperature_c", "humidity_pct", "pressure_hpa",
              "wind_speed_kmh"]:
        assert c in UNIFIED_COLUMNS


def test_nan_is_not_a_number(spark):
    assert one(spark, parse_measure, "inf", "string") is None
    assert not math.isnan(one(spark, f_to_c, 57.7))
