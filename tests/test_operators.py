"""Small hand-made frames for joins, upsert, edits and shares."""

import datetime as dt

from pyspark.sql import functions as F

from stratus.operators.dedup import repeated_keys, unique_key_violations
from stratus.operators.joins import enrich_stations, enrich_stations_default
from stratus.operators.queries import latest_n, share_by
from stratus.sinks.tables import delete_where, update_where, upsert

T0 = dt.datetime(2024, 10, 1, 0, 0)
T1 = dt.datetime(2024, 10, 1, 1, 0)


def test_enrich_last_wins_and_unknown(spark):
    obs = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "station_id string, temperature_c double")
    dim = spark.createDataFrame(
        [("a", "old", 1.0, 1.0, 1.0, "t", 1), ("a", "new", 2.0, 2.0, 2.0, "t", 2)],
        "station_id string, station_name string, latitude double, longitude double, elevation double, "
        "station_type string, pos long")
    r = {x.temperature_c: x for x in enrich_stations(obs, dim).collect()}
    assert r[1.0].station_name == "new" and r[2.0].station_name is None and r[3.0].station_name is None
    d = {x.temperature_c: x for x in enrich_stations_default(obs, dim).collect()}
    assert d[2.0].station_name == "Unknown_b" and d[2.0].station_type == "weather_underground"
    assert d[3.0].station_name is None


def test_upsert_replaces_keys_last_update_wins(spark):
    schema = "station_id string, timestamp timestamp_ntz, temperature_c double, pos long"
    tgt = spark.createDataFrame([("a", T0, 1.0, 1), ("a", T1, 2.0, 2), (None, None, 9.0, 3)], schema)
    upd = spark.createDataFrame([("a", T1, 20.0, 10), ("a", T1, 21.0, 11), ("b", T0, 5.0, 12),
                                 (None, None, 8.0, 13)], schema)
    out = {(r.station_id, r.timestamp): r.temperature_c for r in upsert(tgt, upd, "pos").collect()}
    assert out == {("a", T0): 1.0, ("a", T1): 21.0, ("b", T0): 5.0, (None, None): 8.0}


def test_repeated_keys_null_keys_equal(spark):
    df = spark.createDataFrame([(None, None, 1), (None, None, 2), ("a", T0, 3)],
                               "station_id string, timestamp timestamp_ntz, pos long")
    assert [(r.station_id, r.timestamp, r["_first"]) for r in repeated_keys(df, order="pos").collect()] == [(None, None, 1)]
    v = unique_key_violations(df).collect()
    assert len(v) == 1 and v[0].n == 2


def test_edits_and_shares(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("y", "a", 2.0), ("x", None, 3.0)],
                               "source string, station_id string, temperature_c double")
    up = update_where(df, F.col("station_id") == "a", {"temperature_c": 0.0})
    assert sorted(r.temperature_c for r in up.collect()) == [0.0, 0.0, 3.0]
    kept = delete_where(df, F.col("station_id") == "a")  # null predicate keeps the row
    assert kept.count() == 1
    shares = {r.source: r.share_pct for r in share_by(df, "source").collect()}
    assert shares == {"x": 66.7, "y": 33.3}


def test_latest_n_top_k(spark):
    rows = [("s", dt.datetime(2024, 10, 1, h), float(h)) for h in range(24)] + [("t", T0, 0.0)]
    df = spark.createDataFrame(rows, "station_id string, timestamp timestamp_ntz, temperature_c double")
    got = [r.temperature_c for r in latest_n(df, "s", 3).collect()]
    assert got == [23.0, 22.0, 21.0]
