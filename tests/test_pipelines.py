"""Raw files through the jobs (FIXTURES F1-F4), expectations computed by hand."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from stratus.plans import pipelines as P
from stratus.sources.jsonl import line_numbers, nonblank, parse_records, quarantine, scan_lines

NB = " "


def wu(time, temp="57.7", **kw):
    rec = {"Time": time, "Temperature": f"{temp}{NB}°F", "Dew Point": f"55.0{NB}°F", "Humidity": f"87{NB}%",
           "Wind": "NNE", "Speed": f"8.1{NB}mph", "Gust": f"10.0{NB}mph", "Pressure": f"29.59{NB}in",
           "Precip. Rate": f"0.00{NB}in", "Precip. Accum.": f"0.00{NB}in", "UV": "0", "Solar": f"0{NB}w/m²"}
    rec.update(kw)
    return rec


def write(root, rel, lines):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_cloud_transform_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    write(root, "BE/011024/day.jsonl", [
        json.dumps({"_airbyte_data": wu("12:04 AM")}),
        "",
        "{not json",
        json.dumps(wu("12:04 AM", temp="60.0")),          # same key: first wins
        json.dumps({"_airbyte_data": wu("1:05 PM")}),
        json.dumps({"_airbyte_data": wu("13:05 PM")}),   # invalid clock -> null timestamp
    ])
    write(root, "FR/011024/day.jsonl", [json.dumps({"_airbyte_data": wu("12:04 AM")})])
    write(root, "infoclimat/all.json", [
        json.dumps({"_airbyte_data": {"id_station": "07015", "dh_utc": "2024-10-01 00:00:00",
                                      "temperature": "12.5", "humidite": 80, "temps_omm": None}}),
        json.dumps({"_airbyte_data": {"id_station": "07015", "dh_utc": "2024-10-01 01:00:00",
                                      "temperature": "x", "pression": 1013.2}}),
    ])
    write(root, "misc/notes.jsonl", [json.dumps({"level": "info"})])
    write(root, "BE/011024/ignored.txt", [json.dumps({"_airbyte_data": wu("2:00 PM")})])
    lines = scan_lines(spark, root)
    assert len(lines.inputFiles()) == 4  # suffix filter, all levels
    out = P.cloud_transform(lines)
    rows = {(r.station_id, r.timestamp): r for r in out.collect()}
    assert len(rows) == 6
    be = rows[("IICHTE19", dt.datetime(2024, 10, 1, 0, 4))]
    assert be.temperature_c == 14.28 and be.wind_direction_deg == 22.5 and be.pressure_hpa == 1002.03
    assert be.station_name == "WeerstationBS" and be.wind_speed_kmh == 13.04
    assert ("IICHTE19", dt.datetime(2024, 10, 1, 13, 5)) in rows
    assert ("IICHTE19", None) in rows
    assert ("ILAMAD25", dt.datetime(2024, 10, 1, 0, 4)) in rows
    ic = rows[("07015", dt.datetime(2024, 10, 1, 0, 0))]
    assert ic.temperature_c == 12.5 and ic.humidity_pct == 80.0 and ic.station_type == "infoclimat_api"
    assert rows[("07015", dt.datetime(2024, 10, 1, 1, 0))].temperature_c is None


def test_quarantine_line_numbers(spark, tmp_path):
    root = str(tmp_path / "q")
    write(root, "a.jsonl", ["{}", "", "[1]", "{bad", "{}"])
    lines = scan_lines(spark, root)
    q = quarantine(parse_records(nonblank(lines)))
    numbered = line_numbers(lines, q).orderBy("line_no").collect()
    assert [(r.line_no, r.error) for r in numbered] == [(3, "not a JSON object"), (4, "invalid JSON")]


def test_detect_source_first_record_decides(spark, tmp_path):
    root = str(tmp_path / "mix")
    write(root, "x/m.jsonl", [json.dumps({"Temperature": "1"}), json.dumps({"id_station": "1", "dh_utc": "2024"})])
    recs = P.cloud_records(scan_lines(spark, root))
    assert {r.kind for r in recs.collect()} == {"weather_underground"}
    recs = P.cloud_records(scan_lines(spark, root), detect="record")
    assert sorted(r.kind for r in recs.collect()) == ["infoclimat", "weather_underground"]


def load_line(**kw):
    base = {"source": "infoclimat", "station_id": "07015", "station_name": "S", "latitude": 50.1,
            "longitude": 3.2, "timestamp": "2024-10-01T00:00:00", "humidity_pct": 50.0}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def test_load_rules_and_keys(spark, tmp_path):
    docs = [
        load_line(),                                                # 1 inserted
        load_line(station_name=...),                                # 2 required missing
        load_line(station_name=None),                               # 3 null required -> type
        load_line(source="manual", timestamp="2024-10-01T02:00:00"),  # 4 enum
        load_line(humidity_pct=100.0, timestamp="2024-10-01T03:00:00"),  # 5 accepted
        load_line(humidity_pct=100.01),                             # 6 maximum
        load_line(pressure_hpa=869.99),                             # 7 minimum
        load_line(latitude=50, timestamp="2024-10-01T04:00:00"),    # 8 int widened -> ok
        load_line(weather_code=61, timestamp="2024-10-01T05:00:00"),  # 9 numeric code -> type
        load_line(),                                                # 10 duplicate of 1
        load_line(humidity_pct=101.0),                              # 11 schema + key -> schema
        load_line(timestamp="2024-10-01T08:00:00Z"),                # 12 Z accepted
        load_line(timestamp="2024-10-01T10:00:00+02:00"),           # 13 converted -> same key as 12
        load_line(timestamp="yesterday"),                           # 14 unparseable
    ]
    root = str(tmp_path / "load")
    write(root, "weather_data.jsonl", docs)
    lines = scan_lines(spark, root)
    out = P.load(lines).orderBy("pos").collect()
    status = [(r.status, r.reject_type) for r in out]
    assert status == [
        ("inserted", None), ("rejected", "schema_validation"), ("rejected", "schema_validation"),
        ("rejected", "schema_validation"), ("inserted", None), ("rejected", "schema_validation"),
        ("rejected", "schema_validation"), ("inserted", None), ("rejected", "schema_validation"),
        ("rejected", "duplicate_key"), ("rejected", "schema_validation"), ("inserted", None),
        ("rejected", "duplicate_key"), ("rejected", "schema_validation"),
    ]
    assert out[1].violations == ["required:station_name"]
    assert out[2].violations == ["type:station_name"]
    assert out[13].violations == ["type:timestamp"]
    acct = P.import_accounting(P.load(lines)).first()
    assert acct.total_submitted == acct.total_inserted + acct.total_errors == 14


def test_load_twice_append_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "load2")
    write(root, "d.jsonl", [load_line(), load_line(timestamp="2024-10-02T00:00:00"), load_line()])
    table = str(tmp_path / "table")
    lines = scan_lines(spark, root)
    P.run_load(spark, lines, table, "reset").collect()
    first = sorted(spark.read.parquet(table).select("station_id", "timestamp").collect())
    rep = {(r.section, r.key): r.num for r in P.run_load(spark, lines, table, "append").collect()}
    again = sorted(spark.read.parquet(table).select("station_id", "timestamp").collect())
    assert first == again and len(first) == 2
    assert rep[("import", "total_inserted")] == 0 and rep[("import", "duplicate_key")] == 3


def test_nested_document(spark, tmp_path):
    from stratus.sources.document import explode_documents, read_documents
    doc = {
        "stations": [{"id": "00052", "name": "old", "latitude": 1, "longitude": 2, "elevation": 3, "type": "t"},
                     {"id": "00052", "name": "Armentieres", "latitude": 50.7, "longitude": 2.9,
                      "elevation": 16, "type": "synop"}],
        "hourly": {
            "00052": [{"dh_utc": "2024-10-01 00:00:00", "temperature": "12.3", "humidite": 90},
                      {"dh_utc": "bad", "temperature": "n/a"}],
            "99999": [{"dh_utc": "2024-10-01 01:00:00", "pression": "1015"}],
            "_params": {"unit": "metric"},
        },
    }
    root = str(tmp_path / "docs")
    write(root, "d.json", [json.dumps(doc)])
    rows = explode_documents(read_documents(spark, root)).orderBy("station_id", "row_id").collect()
    assert [(r.station_id, r.station_name) for r in rows] == [
        ("00052", "Armentieres"), ("00052", "Armentieres"), ("99999", None)]
    assert rows[0].temperature_c == 12.3 and rows[0].elevation == 16.0
    assert rows[1].timestamp is None and rows[1].temperature_c is None
    assert rows[2].pressure_hpa == 1015.0 and rows[2].latitude is None


def test_quality_report_empty(spark):
    from stratus.operators.quality import quality_report
    from stratus.schema import UNIFIED_SCHEMA
    empty = spark.createDataFrame([], UNIFIED_SCHEMA)
    rows = {(r.section, r.key): (r.num, r.txt) for r in quality_report(empty, "local").collect()}
    assert rows[("total_records", None)] == (0.0, None)
    assert rows[("anomalies", None)] == (None, "DataFrame vide")
    assert rows[("duplicates", None)] == (0.0, None)


def test_dedup_idempotent(spark):
    from stratus import standin as S
    from stratus.operators.dedup import dedup_keep_first
    obs = S.observations(spark, "/root/testdata/sf0.001")
    once = dedup_keep_first(obs, order=["pos"])
    twice = dedup_keep_first(once, order=["pos"])
    assert once.count() == twice.count()
    assert once.select("pos").subtract(twice.select("pos")).count() == 0


def test_run_cloud_end_to_end(spark, tmp_path):
    root = str(tmp_path / "raw2")
    write(root, "BE/011024/a.jsonl", [json.dumps({"_airbyte_data": wu("12:04 AM")}),
                                      json.dumps({"_airbyte_data": wu("12:05 AM")})])
    out_dir = str(tmp_path / "out")
    written = P.run_cloud(spark, root, out_dir)
    assert written.count() == 2
    rep = spark.read.option("multiLine", True).json(f"{out_dir}/weather_data.quality").first()  # one JSON document
    assert rep.total_records == 2 and rep.duplicates == 0
    exported = [json.loads(line) for f in os.listdir(f"{out_dir}/weather_data") if f.endswith(".json")
                for line in open(f"{out_dir}/weather_data/{f}")]
    assert all(len(r) == 23 for r in exported)
    assert {r["timestamp"] for r in exported} == {"2024-10-01T00:04:00", "2024-10-01T00:05:00"}


def test_require_rows_raises(spark):
    import pytest
    from stratus.sources.jsonl import require_rows
    with pytest.raises(ValueError):
        require_rows(spark.range(0), "empty")
