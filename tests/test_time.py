import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratus.functions import combine_date_time, date_from_path, iso_timestamp, ts_to_iso


@pytest.mark.parametrize("path,dmy,mdy", [
    ("/raw/BE/011024/x.jsonl", dt.date(2024, 10, 1), dt.date(2024, 1, 10)),
    ("/raw/BE/131024/x.jsonl", dt.date(2024, 10, 13), None),
    ("/raw/BE/x.jsonl", None, None),
])
def test_date_from_path(spark, path, dmy, mdy):
    r = spark.createDataFrame([(path,)], "p string").select(
        date_from_path("p", "DMY").alias("a"), date_from_path("p", "MDY").alias("b")).first()
    assert (r["a"], r["b"]) == (dmy, mdy)


@pytest.mark.parametrize("t,exp", [
    ("12:04 AM", dt.datetime(2024, 10, 1, 0, 4)), ("12:04 AM", dt.datetime(2024, 10, 1, 0, 4)),
    ("1:05 pm", dt.datetime(2024, 10, 1, 13, 5)), ("1:5 PM", dt.datetime(2024, 10, 1, 13, 5)),
    ("13:05 PM", None), ("1:05PM", None), (" 1:05 PM", None), (None, None),
])
def test_combine_date_time(spark, t, exp):
    r = spark.createDataFrame([(dt.date(2024, 10, 1), t)], "d date, t string").select(
        combine_date_time("d", "t").alias("ts")).first()
    assert r["ts"] == exp


@pytest.mark.parametrize("txt,conv,drop", [
    ("2024-10-01T10:00:00Z", dt.datetime(2024, 10, 1, 10), dt.datetime(2024, 10, 1, 10)),
    ("2024-10-01T10:00:00+02:00", dt.datetime(2024, 10, 1, 8), dt.datetime(2024, 10, 1, 10)),
    ("garbage", None, None), ("2024", None, None), ("", None, None),
])
def test_iso(spark, txt, conv, drop):
    r = spark.createDataFrame([(txt,)], "x string").select(
        iso_timestamp("x", "convert").alias("c"), iso_timestamp("x", "drop").alias("d")).first()
    assert (r["c"], r["d"]) == (conv, drop)


def test_ts_to_iso(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 10, 1, 0, 4),), (dt.datetime(2024, 10, 1, 0, 4, 5, 120000),)],
                               "t timestamp_ntz")
    out = [r[0] for r in df.select(ts_to_iso("t")).collect()]
    assert out == ["2024-10-01T00:04:00", "2024-10-01T00:04:05.120000"]


def test_iso_convert_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-10-01T10:00:00+02:00",), ("2024-10-01T10:00:00",), ("2024-10-01",)],
                                   "x string")
        out = [r[0] for r in df.select(iso_timestamp("x", "convert")).collect()]
        assert out == [dt.datetime(2024, 10, 1, 8), dt.datetime(2024, 10, 1, 10), dt.datetime(2024, 10, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
