"""Inputs that must not be lost or changed without a word."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratus.functions.text import parse_measure
from stratus.functions.time import combine_date_time_multi, iso_timestamp
from stratus.operators.normalize import payload_quarantine
from stratus.plans import pipelines as P
from stratus.schema import UNIFIED_COLUMNS
from stratus.sinks import tables as T
from stratus.sources.document import document_quarantine, explode_documents
from stratus.sources.jsonl import parse_records, relative_path, resolved_root, scan_lines

WU = '{"Time": "1:0%d PM", "Temperature": "50.0 F"}\n'


def lines_of(spark, *values):
    return spark.createDataFrame([("f", 0, i, v, "/f") for i, v in enumerate(values)],
                                 "file_path string, split_start long, row_id long, value string, rel_path string")


def test_encoded_roots_keep_stations_and_days(spark, tmp_path):
    root = tmp_path / "my dir é" / "raw"
    for place in ("BE", "FR"):
        folder = root / place / "010124"
        folder.mkdir(parents=True)
        (folder / "a+b.jsonl").write_text("".join(WU % i for i in range(3)))
    scanned = scan_lines(spark, str(root))
    assert {r.rel_path for r in scanned.collect()} == {"/BE/010124/a+b.jsonl", "/FR/010124/a+b.jsonl"}
    rows = P.cloud_transform(scanned).collect()
    assert len(rows) == 6 and {r.station_id for r in rows} == {"IICHTE19", "ILAMAD25"}
    with pytest.raises(Exception, match="not under"):
        other = resolved_root(spark, str(tmp_path / "else"))
        scanned.select(relative_path(F.col("file_path"), other)).collect()


def test_lines_are_exactly_one_object(spark):
    good = ['{"a":1}', ' {"a":{"b":[{"c":1}]},"d":2} ', '{"a":"} ] x"}', '{"a":1,"a":2}']
    bad = ['{"a":1} trailing', '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1}]', '{"a":1}] [{"b":2}', '{"a":1}] {"b":2}', "[1]", "5", "null", '{"a":']
    rows = {r.row_id: r for r in parse_records(lines_of(spark, *good, *bad)).collect()}
    assert all(rows[i].parse_error is None for i in range(len(good))) and rows[3].rec == {"a": "2"}
    assert all(rows[i].parse_error for i in range(len(good), len(good) + len(bad)))
    loaded = P.load(lines_of(spark, *good, *bad)).collect()
    assert [r.row_id for r in loaded if r.parse_error is None] == [0, 1, 2, 3]


def test_payloads_that_are_no_objects_are_quarantined(spark):
    parsed = parse_records(lines_of(spark, '{"_airbyte_data": null}', '{"_airbyte_data": [1]}', '{"_airbyte_data": {"a": 1}}', '{"a": 1}'))
    assert [r.row_id for r in payload_quarantine(parsed).orderBy("row_id").collect()] == [0, 1]


def test_documents_lose_only_what_is_bad(spark):
    docs = spark.createDataFrame([
        ("/a", '{"stations": [], "hourly": {"1": [{"dh_utc": "2024-01-01 00:00:00"}, 5, {"dh_utc": "2024-01-01 01:00:00"}], "_p": {}}}'),
        ("/b", '{"stations": [], "hourly": {"2": [{"dh_utc": "2024-01-01 0'), ("/c", '{"hourly": {"3": {"x": 1}}}'), ("/d", '{"hourly": {"4": []}}')],
        "file_path string, value string")
    assert [(r.station_id, r.row_id) for r in explode_documents(docs).orderBy("row_id").collect()] == [("1", 0), ("1", 2)]
    assert {(r.file_path, r.error) for r in document_quarantine(docs).collect()} == {
        ("/a", "record is not an object"), ("/b", "invalid document"), ("/c", "records are not a list")}


def test_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    assert T._existing_keys(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception):
        T._existing_keys(spark, str(tmp_path / "t")).collect()


def test_bad_line_on_read_back_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"source": "a"}\n{"source": \n')
    with pytest.raises(Exception):
        T.read_unified(spark, str(tmp_path / "x.json")).collect()


def test_empty_input_leaves_the_old_export(spark, tmp_path):
    root, out = tmp_path / "in" / "BE" / "010124", tmp_path / "out"
    root.mkdir(parents=True)
    (root / "a.jsonl").write_text(WU % 1)
    assert P.run_cloud(spark, str(tmp_path / "in"), str(out)).count() == 1
    (root / "a.jsonl").write_text('{"other": 1}\n')
    with pytest.raises(ValueError):
        P.run_cloud(spark, str(tmp_path / "in"), str(out))
    assert T.read_unified(spark, str(out / "weather_data")).count() == 1
    assert [p.name for p in out.iterdir() if p.name.startswith("weather_data.") and len(p.name) == 25] == []


def test_load_without_accepted_rows_reports_zeros(spark, tmp_path):
    report = {(r.section, r.key): r.num for r in P.run_load(spark, lines_of(spark, '{"a": 1}'), str(tmp_path / "t")).collect()}
    assert report[("import", "total_inserted")] == 0 and report[("total_documents", None)] == 0


def test_wide_integers_are_long(spark):
    row = '{"source":"infoclimat","station_id":"1","station_name":"a","latitude":1.0,"longitude":1.0,"timestamp":"2024-01-0%dT00:00:00","uv_index":%s}'
    got = P.load(lines_of(spark, row % (1, "3000000000"), row % (2, "3"))).orderBy("row_id").collect()
    assert got[0].violations == ["type:uv_index"] and got[1].violations == []


def test_cloud_names_are_counted(spark):
    row = '{"source":"%s","station_id":"1","timestamp":"2024-01-01T00:00:00"}'
    out = P.load(lines_of(spark, row % "infoclimat", row % "infoclimat", row % "x"), "core", "drop", names="cloud")
    got = P.import_accounting(out, "cloud").first()
    assert (got.total_inserted, got.validation, got.duplicate, got.other) == (1, 1, 1, 0)


def test_update_sees_the_row_as_it_was(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "station_id string, t int")
    got = T.update_where(df, F.col("station_id") == "a", {"station_id": "b", "t": 0}).collect()
    assert [tuple(r) for r in got] == [("b", 0), ("b", 2)]


def test_blanks_clocks_and_zones(spark):
    df = spark.createDataFrame([("57.7 F", "12:04:30 AM", "2024-11-03T06:30:00Z"), ("57.7　F", "1:05PM", "2024-11-03T06:30:00+00:00")],
                               "m string, c string, z string").withColumn("d", F.lit(dt.date(2024, 3, 31)))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(parse_measure("m").alias("m"), combine_date_time_multi("d", "c").alias("c"), iso_timestamp("z").alias("z")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.m for r in got] == [57.7, 57.7]
    assert [r.c for r in got] == [dt.datetime(2024, 3, 31, 0, 4, 30), dt.datetime(2024, 3, 31, 13, 5)]
    assert {r.z for r in got} == {dt.datetime(2024, 11, 3, 6, 30)}


def test_layout_keeps_the_order_within_files(spark, tmp_path):
    from stratus.standin import observations
    obs = observations(spark, "/root/testdata/sf0.001")
    T.write_layout(obs.repartition(3), str(tmp_path / "t"))
    checked = 0
    for path in (tmp_path / "t").rglob("*.parquet"):
        keys = [(r.station_id is not None, r.station_id, r.timestamp is not None, r.timestamp) for r in spark.read.parquet(str(path)).collect()]
        assert [k[:2] for k in keys] == sorted((k[:2] for k in keys), key=lambda k: (k[0], k[1] or ""))
        checked += len(keys)
    assert checked == obs.count() and set(T.scan_table(spark, str(tmp_path / "t")).columns) == set(UNIFIED_COLUMNS)


def test_typed_queries_scan_without_shuffling_their_input(spark):
    from stratus.catalog import QUERIES
    for name in ("count_total", "latest_10", "filter_station", "quality_report"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "RoundRobin" not in plan
    assert "EqualTo(station_id,7)" in QUERIES["filter_station"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
