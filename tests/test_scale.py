"""What keeps the jobs' work in step with their input: one parse, pruned scans,
touched files only, order without a global sort."""

import contextlib
import datetime as dt
import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import stratus.plans.pipelines as P
from stratus.functions.text import BLANKS, is_blank, strip_blank
from stratus.operators.normalize import sheet_rows
from stratus.operators.quality import QUALITY_LAYOUT, quality_report, report_lines
from stratus.schema import KEY_COLUMNS, UNIFIED_COLUMNS, UNIFIED_SCHEMA
from stratus.session import split_methods
from stratus.sinks import tables as T
from stratus.sources.document import explode_documents
from stratus.sources.jsonl import nonblank, scan_lines
from tests.test_losses import lines_of

DAY = dt.datetime(2024, 3, 1)


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def observations(spark, stations=24, hours=240, source="infoclimat"):
    rows = spark.range(stations * hours).select(
        F.lit(source).alias("source"), F.format_string("s%03d", F.col("id") % stations).alias("station_id"),
        (F.lit(DAY).cast("timestamp_ntz") + F.expr(f"make_dt_interval(0, CAST(id div {stations} AS INT))")).alias("timestamp"),
        F.col("id").cast("double").alias("temperature_c"))
    return rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in UNIFIED_SCHEMA))


def many_files(spark):
    return settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"})


def files_for(path, column, low, high):
    """Files whose statistics say that they may hold a value in [low, high]."""
    hit, every = 0, glob.glob(f"{path}/*/*.parquet")
    for file in every:
        meta = pq.ParquetFile(file).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(s.max >= low and s.min <= high for s in stats)
    return hit, len(every)


def test_layout_prunes_files_by_station_and_by_time(spark, tmp_path):
    with many_files(spark):
        T.write_layout(observations(spark), str(tmp_path / "t"))
    station = files_for(tmp_path / "t", "station_id", "s007", "s007")
    day = files_for(tmp_path / "t", "timestamp", DAY + dt.timedelta(days=4), DAY + dt.timedelta(days=4, hours=20))
    assert station[1] >= 24 and station[0] <= station[1] / 3 and day[0] <= day[1] / 3, (station, day)
    assert T.scan_table(spark, str(tmp_path / "t")).count() == 24 * 240


def test_hot_station_is_split_by_time(spark, tmp_path):
    rows = observations(spark, 2, 4000).withColumn("station_id", F.when(F.col("temperature_c") % 20 == 0, "cold").otherwise("hot"))
    with many_files(spark):
        T.write_layout(rows, str(tmp_path / "t"))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/t/*/*.parquet")]
    assert len(sizes) >= 20 and max(sizes) < 8000 / 8


def test_edits_leave_other_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    with many_files(spark):
        T.write_layout(observations(spark), path)
    names = lambda: set(glob.glob(f"{path}/*/*.parquet"))
    before, table = names(), T.scan_table(spark, path)
    touched = {"/" + r[0].split(":", 1)[1].lstrip("/") for r in table.filter("station_id = 's003' AND temperature_c < 500").select("_metadata.file_path").distinct().collect()}
    T.update_table(spark, path, (F.col("station_id") == "s003") & (F.col("temperature_c") < 500), {"temperature_c": -1.0})
    after = names()
    assert before - after == touched and len(touched) < len(before) / 3
    assert T.scan_table(spark, path).filter("temperature_c = -1").count() == 21
    updates = T.scan_table(spark, path).filter("station_id = 's010' AND temperature_c < 300").withColumn("pos", F.lit(1)).withColumn("uv_index", F.lit(3.0)).withColumn("source", F.lit("new"))
    T.upsert_table(spark, path, updates)
    assert len(after - names()) < len(after) / 3
    rows = T.scan_table(spark, path)
    assert rows.count() == 24 * 240 and rows.filter("source = 'new' AND uv_index = 3").count() == 13
    T.delete_from_table(spark, path, F.col("source") == "new")
    assert T.scan_table(spark, path).count() == 24 * 240 - 13
    assert not glob.glob(f"{path}/_s*")


def test_interrupted_swap_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    T.write_layout(observations(spark, 3, 20), path)
    real = T._Files.move

    def fail(self, source, target):
        real(self, source, target)
        raise OSError("lost")

    monkeypatch.setattr(T._Files, "move", fail)
    with pytest.raises(OSError):
        T.update_table(spark, path, F.col("station_id") == "s001", {"uv_index": 1.0})
    monkeypatch.setattr(T._Files, "move", real)
    T.finish_swaps(spark, path)
    T.finish_swaps(spark, path)
    rows = T.scan_table(spark, path)
    assert rows.count() == 60 and rows.filter("uv_index = 1").count() == 20 and not glob.glob(f"{path}/_s*")


def test_stored_keys_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    T.write_layout(observations(spark), path)
    batch = observations(spark).filter("station_id IN ('s005', 's006') AND temperature_c < 1000").select(*KEY_COLUMNS)
    near = T.pruned_keys(T._existing_keys(spark, path), batch)
    assert 84 <= near.count() <= 90  # 84 keys, and what the Bloom filter lets through
    plan = near._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "station_id" in pushed and "timestamp" in pushed and "source" not in plan.split("ReadSchema")[1]
    outside = batch.withColumn("station_id", F.lit("zzz"))
    assert T.pruned_keys(T._existing_keys(spark, path), outside).count() == 0
    assert T.bloom_filter(batch, 64 * T.BLOOM_WORDS) is None


def test_stored_and_null_keys_count_as_duplicates(spark):
    schema = "station_id string, timestamp timestamp_ntz, pos long, ok boolean"
    rows = spark.createDataFrame([(None, None, 1, True), (None, None, 2, True), ("a", DAY, 3, True), ("b", DAY, 4, True), ("b", DAY, 5, True),
                                  ("b", DAY, 0, False), (None, DAY, 6, True)], schema)
    stored = spark.createDataFrame([("a", DAY), ("a", DAY), (None, DAY), ("c", DAY)], "station_id string, timestamp timestamp_ntz")
    got = {r.pos: r.duplicate for r in T.insert_ignore_plan(rows, stored, valid=F.col("ok")).collect()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: True, 0: False, 6: True}
    assert {r.pos for r in T.insert_ignore_plan(rows, None).collect() if r.duplicate} == {2, 4, 5}
    assert T.insert_ignore_plan(rows.limit(0), stored, valid=F.col("ok")).collect() == []


def test_cloud_job_parses_once_and_hashes(spark, monkeypatch):
    plans = {}
    real = P.cut_lineage

    def seen(df, name="stage"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(P, "cut_lineage", seen)
    lines = lines_of(spark, '{"_airbyte_data": {"Time": "1:00 PM", "Temperature": "50 F", "Time": "2:00 PM"}}', '{"a": 1}', "x")
    out = P.cloud_transform(lines)
    plans["rows"] = out._jdf.queryExecution().executedPlan().toString()
    assert plans["parsed"].count("from_json(") == 2 and "from_json" not in plans["rows"]
    assert "SortAggregate" not in "".join(plans.values())
    P.local_transform(spark.createDataFrame([], "file_path string, value string"), lines).collect()
    assert plans["sheets"].count("from_json(") == 1


def test_export_comes_in_input_order(spark, tmp_path):
    for place in ("BE", "FR"):
        folder = tmp_path / "in" / place / "010124"
        folder.mkdir(parents=True)
        (folder / "x.jsonl").write_text("".join(json.dumps({"Time": f"{1 + i // 60}:{i % 60:02} AM", "Temperature": f"{i}.0 F"}) + "\n" for i in range(300)))
    with many_files(spark):
        P.run_cloud(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = []
    for file in sorted(glob.glob(f"{tmp_path}/out/weather_data/part-*")):
        with open(file) as f:
            got += [(r["station_id"], r["timestamp"]) for r in map(json.loads, f)]
    assert len(got) == 600 and got == sorted(got) and len(glob.glob(f"{tmp_path}/out/weather_data/part-*")) > 8
    report = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/out/weather_data.quality/part-*"))
    assert json.loads(report)["records_per_station"] == {"IICHTE19": 300, "ILAMAD25": 300}


def test_report_of_a_station_named_null(spark):
    rows = observations(spark, 3, 5).withColumn("station_id", F.when(F.col("station_id") == "s000", None).when(F.col("station_id") == "s001", "null").otherwise('q"\\'))
    lines = report_lines(quality_report(rows, "local"), QUALITY_LAYOUT).orderBy("part", "place", "key").collect()
    doc = json.loads("\n".join(r.line for r in lines))
    assert doc["records_per_station"] == {"null": 10, 'q"\\': 5} and doc["total_records"] == 15 and doc["anomalies"] == []
    empty = json.loads("\n".join(r.line for r in report_lines(quality_report(rows.limit(0), "local"), QUALITY_LAYOUT).orderBy("part", "place", "key").collect()))
    assert empty["total_records"] == 0 and empty["anomalies"] == ["DataFrame vide"] and empty["records_per_source"] == {}


def test_load_report_names_lines(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = {c: None for c in UNIFIED_COLUMNS} | {"source": "infoclimat", "station_id": "1", "station_name": "n", "latitude": 1, "longitude": 2.0, "timestamp": "2024-01-01T00:00:00"}
    (folder / "a.jsonl").write_text("\n".join([json.dumps(good), "", "{bad", json.dumps(good), json.dumps(good | {"latitude": 100})]) + "\n")
    P.run_load(spark, scan_lines(spark, str(folder)), str(tmp_path / "t"), report_path=str(tmp_path / "report"))
    doc = json.loads("".join(open(f).read() for f in glob.glob(f"{tmp_path}/report/part-*")))
    assert doc["import"]["parse_errors_sample"] == [{"line": 3, "error": "invalid JSON", "raw": "{bad"}]
    assert [e["type"] for e in doc["import"]["errors_sample"]] == ["duplicate_key", "schema_validation"]
    assert doc["import"]["error_types"] == {"duplicate_key": 1, "schema_validation": 1} and doc["quality"]["by_source"] == {"infoclimat": 1}


def test_large_document(spark, tmp_path):
    """Beyond the size of one VARIANT, thousands of stations, ids that repeat."""
    n = 6000
    stations = [{"id": str(i), "name": "old"} for i in range(n)] + [{"id": str(i), "name": f"n{i}"} for i in range(0, n, 2)] + [{"name": "no id"}]
    records = [{"dh_utc": "2024-01-01 00:00:00", "temperature": 1.5, "note": "x" * 2900}]
    (tmp_path / "d.json").write_text(json.dumps({"stations": stations, "hourly": {str(i): records for i in range(n)} | {"_params": {}}}))
    assert os.path.getsize(tmp_path / "d.json") > 17_000_000
    from stratus.sources.document import read_documents
    got = explode_documents(read_documents(spark, str(tmp_path))).select("station_id", "station_name", "temperature_c").collect()
    assert len(got) == n and all(r.station_name == ("old" if int(r.station_id) % 2 else f"n{r.station_id}") and r.temperature_c == 1.5 for r in got)


def test_sheets_without_columns(spark):
    from stratus.operators.normalize import missing_sheet_columns, require_sheet_columns
    rows = spark.createDataFrame([("a", {"Time": "1", "Temperature": None}), ("a", {"Time": "2", "Wind": "N"}), ("b", {"x": "1"})], "file_path string, payload map<string,string>")
    assert [(r.file_path, len(r.missing)) for r in missing_sheet_columns(rows).collect()] == [("a", 7)]
    with pytest.raises(KeyError, match="missing columns in a"):
        require_sheet_columns(rows)


def test_layout_place_is_found_by_halving(spark):
    """The place of a row is computed once: no function over all quantiles, twelve times a row."""
    rows = spark.range(500).select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("station_id", "timestamp") else
                                     F.expr("CASE WHEN id % 50 <> 3 THEN 's' || id % 7 END").alias(f.name) if f.name == "station_id" else
                                     F.expr("CASE WHEN id % 60 <> 4 THEN TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, int(id * id % 997)) END").alias(f.name)
                                     for f in UNIFIED_SCHEMA.fields))
    placed = T.with_place(rows, bits=3)
    assert "lambda" not in placed._jdf.queryExecution().optimizedPlan().toString()
    station = lambda r: int.from_bytes((r.station_id or "").encode().ljust(7, b"\0")[:7])
    time = lambda r: int(r.timestamp.replace(tzinfo=dt.timezone.utc).timestamp()) if r.timestamp else 0
    found = placed.collect()
    cuts = [[sorted(map(x, found))[-(-i * len(found) // 8) - 1] for i in range(1, 8)] for x in (station, time)]
    for r in found:
        a, b = (sum(p < x(r) for p in c) for x, c in zip((station, time), cuts, strict=True))
        assert r._place == sum((a >> i & 1) << 2 * i + 1 | (b >> i & 1) << 2 * i for i in range(3))
    assert T.with_place(rows.limit(0)).count() == 0


def test_stored_stages_run_as_compiled_functions(spark):
    """Wide projections of a stored stage are split into functions in any session, whose setting comes back."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "65535")
    try:
        with split_methods(spark):
            assert spark.conf.get(name) == "8000"
        assert spark.conf.get(name) == "65535"
        with pytest.raises(ZeroDivisionError), split_methods(spark):
            raise ZeroDivisionError
        assert spark.conf.get(name) == "65535"
    finally:
        spark.conf.set(name, before)


def test_sheet_rows_read_a_path_once_per_file(spark):
    """Day and station of a sheet come from the table of files, and a time cell is cleaned once a row."""
    lines = [("/in/IICHTE19/010324.jsonl", 0, i, json.dumps({"Time": t, "UV": "1"})) for i, t in enumerate(["1:05  PM", " 13:05:06 ", "2024-03-01 07:08:09", "x", None])]
    lines += [("/in/ILAMAD25/notes.jsonl", 0, 9, '{"Time": "1:05 PM"}'), ("/in/ILAMAD25/020324.jsonl", 0, 10, '{"UV": "1"}')]
    sheets = spark.createDataFrame(lines, "file_path string, split_start long, row_id long, value string").repartition(2)
    stage = P.sheet_stage(sheets)
    rows = sheet_rows(stage, F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1))
    got = {r.row_id: r for r in rows.collect()}
    at = lambda *hms: dt.datetime(2024, 3, 1, *hms)
    assert {k: r.timestamp for k, r in got.items()} == {0: at(13, 5), 1: at(13, 5, 6), 2: at(7, 8, 9), 3: None, 4: None}
    assert {r.station_id for r in got.values()} == {"IICHTE19"}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert all("_has_time" in line for line in plan.splitlines() if "[^/]" in line) and plan.count("(?U)") == 1


def test_blank_check_stops_at_first_character(spark):
    """A long line is not rewritten to tell that it is not blank; what counts as blank is as before."""
    texts = [None, "", " ", BLANKS, BLANKS[::-1] + " ", "x", " x", "x ", " é ", "　​", "   \U0001f600", "﻿"]
    texts += [" " + b for b in BLANKS]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    checked = rows.select("value", is_blank("value").alias("now"), (strip_blank("value") == "").alias("plain"))
    assert all(r.now is r.plain for r in checked.collect())
    assert "translate" not in nonblank(rows)._jdf.queryExecution().optimizedPlan().toString()
