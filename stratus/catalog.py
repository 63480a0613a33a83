"""Registered queries: one per operator of the inventory, each with the SQL
statement (DuckDB dialect, over the driver's tables) that states the expected
result independently of the Spark implementation.

Every query reads the full driver tables (through :mod:`stratus.standin`)
and runs the operator under test through the library.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratus import standin as S
from stratus.functions import (
    combine_date_time, combine_date_time_multi, compass_degrees, date_from_path, f_to_c,
    in_to_mm, inhg_to_hpa, iso_timestamp, mph_to_kmh, parse_measure, sanitize_frame, to_double,
    to_timestamp_coerce, ts_to_iso,
)
from stratus.operators import dedup as D, quality as Q, queries as QQ
from stratus.schema import MEASURE_COLUMNS, RULESETS, UNIFIED_COLUMNS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


OBS = f"WITH obs AS (SELECT {S.obs_select_sql('duck')} FROM events)"
U23 = ", ".join(UNIFIED_COLUMNS)


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "events")


# ===========================================================================
# X1-X4 unit conversions

@query("f_to_c", "SELECT event_id, round((value - 32) * 5 / 9, 2) AS temp_c FROM events")
def q_f_to_c(spark, sf):
    return ev(spark, sf).select("event_id", f_to_c("value").alias("temp_c"))


@query("mph_to_kmh", "SELECT event_id, round(value * 1.60934, 2) AS speed_kmh FROM events")
def q_mph(spark, sf):
    return ev(spark, sf).select("event_id", mph_to_kmh("value").alias("speed_kmh"))


@query("inhg_to_hpa", "SELECT event_id, round(value * 33.8639, 2) AS pressure_hpa FROM events")
def q_inhg(spark, sf):
    return ev(spark, sf).select("event_id", inhg_to_hpa("value").alias("pressure_hpa"))


@query("in_to_mm", "SELECT event_id, round(value * 25.4, 2) AS precip_mm FROM events")
def q_in(spark, sf):
    return ev(spark, sf).select("event_id", in_to_mm("value").alias("precip_mm"))


# ===========================================================================
# X5, X6, X8 text parsing

MEASURE_TEXT = """CASE event_id % 8
  WHEN 0 THEN printf('%.2f', value) || chr(160) || '°F'
  WHEN 1 THEN replace(printf('%.2f', value), '.', ',')
  WHEN 2 THEN '--'
  WHEN 3 THEN 'N/A'
  WHEN 4 THEN '<' || printf('%.2f', value) || ' in'
  WHEN 5 THEN printf('%.2f', value) || '°F'
  WHEN 6 THEN '  ' || CAST(event_id % 100 AS STRING) || chr(160) || '%'
  ELSE NULL END"""


@query("parse_measure", f"""
SELECT event_id, {MEASURE_TEXT} AS raw,
  CASE event_id % 8 WHEN 0 THEN value WHEN 1 THEN value WHEN 4 THEN value
    WHEN 6 THEN CAST(event_id % 100 AS DOUBLE) ELSE NULL END AS measure
FROM events""")
def q_parse_measure(spark, sf):
    t = ev(spark, sf).selectExpr("event_id", f"{MEASURE_TEXT} AS raw")
    return t.select("event_id", "raw", parse_measure("raw").alias("measure"))


COMPASS_LIST = ", ".join(f"'{t}'" for t in S.COMPASS_TEXTS + [" NNE ", "north"])


@query("wind_to_degrees", f"""
SELECT event_id, [{COMPASS_LIST}][event_id % 20 + 1] AS wind,
  CASE WHEN event_id % 20 < 16 THEN (event_id % 20) * 22.5
       WHEN event_id % 20 = 18 THEN 22.5 ELSE NULL END AS wind_direction_deg
FROM events""")
def q_wind(spark, sf):
    t = ev(spark, sf).selectExpr("event_id", f"element_at(array({COMPASS_LIST}), CAST(event_id % 20 + 1 AS INT)) AS wind")
    return t.select("event_id", "wind", compass_degrees("wind").alias("wind_direction_deg"))


NUM_TEXT = """CASE event_id % 5
  WHEN 0 THEN CAST(value AS STRING)
  WHEN 1 THEN ' ' || CAST(event_id % 50 AS STRING) || ' '
  WHEN 2 THEN 'abc'
  WHEN 3 THEN '1_000'
  ELSE '1e3' END"""


@query("to_numeric_coerce", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN CAST(event_id % 50 AS DOUBLE)
  WHEN 4 THEN 1000.0 ELSE NULL END AS num
FROM events""")
def q_to_numeric(spark, sf):
    t = ev(spark, sf).selectExpr("event_id", f"{NUM_TEXT} AS raw")
    return t.select("event_id", to_double("raw").alias("num"))


# ===========================================================================
# X7 sanitize

@query("sanitize_non_finite", f"""
SELECT event_id AS pos,
  CASE WHEN event_id % 37 = 0 OR event_id % 41 = 0 THEN NULL ELSE value / 8 - 15 END AS temperature_c,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE value / 7 END AS wind_speed_kmh,
  value / 10 - 20 AS dew_point_c
FROM events""")
def q_sanitize(spark, sf):
    t = ev(spark, sf).selectExpr(
        "event_id AS pos",
        f"{S.NONFINITE_EXPRS['temperature_c']} AS temperature_c",
        f"{S.NONFINITE_EXPRS['wind_speed_kmh']} AS wind_speed_kmh",
        "value / 10 - 20 AS dew_point_c")
    return sanitize_frame(t)


@query("sanitize_nested", """
SELECT event_id AS pos,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS s_value,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 2 END AS a0,
  value / 4 AS a1,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS m_x
FROM events""")
def q_sanitize_nested(spark, sf):
    t = ev(spark, sf).selectExpr(
        "event_id AS pos",
        "named_struct('value', CASE WHEN event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END, "
        "'label', event_type) AS s",
        "array(CASE WHEN event_id % 4 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value / 2 END, value / 4) AS a",
        "map('x', CASE WHEN event_id % 5 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value END) AS m")
    c = sanitize_frame(t)
    return c.select("pos", F.col("s.value").alias("s_value"), F.col("a")[0].alias("a0"),
                    F.col("a")[1].alias("a1"), F.col("m")["x"].alias("m_x"))


# ===========================================================================
# X9-X15 time

TS_TEXT = """CASE event_id % 4
  WHEN 0 THEN {fmt_space}
  WHEN 1 THEN {fmt_t}
  WHEN 2 THEN 'garbage'
  ELSE NULL END"""


@query("to_timestamp_coerce", """
SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN date_trunc('second', ts) END AS ts_parsed
FROM events""")
def q_to_ts(spark, sf):
    txt = TS_TEXT.format(fmt_space="date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
                         fmt_t="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")")
    t = ev(spark, sf).selectExpr("event_id", f"{txt} AS raw")
    return t.select("event_id", to_timestamp_coerce("raw").alias("ts_parsed"))


@query("date_from_path", """
SELECT event_id,
  CASE event_id % 3 WHEN 0 THEN CAST(ts AS DATE)
    WHEN 1 THEN CAST(try_strptime(strftime(ts, '%m%d%y'), '%d%m%y') AS DATE) END AS day_dmy,
  CASE event_id % 3 WHEN 0 THEN CAST(try_strptime(strftime(ts, '%d%m%y'), '%m%d%y') AS DATE)
    WHEN 1 THEN CAST(ts AS DATE) END AS day_mdy
FROM events""")
def q_date_from_path(spark, sf):
    t = ev(spark, sf).select("event_id", F.when(F.col("event_id") % 3 == 0,
                                                F.concat(F.lit("/raw/BE/"), F.date_format("ts", "ddMMyy"), F.lit("/f.jsonl")))
                             .when(F.col("event_id") % 3 == 1,
                                   F.concat(F.lit("/raw/"), F.date_format("ts", "MMddyy"), F.lit("/x.jsonl")))
                             .otherwise(F.concat(F.lit("/raw/nodate/"), F.col("event_id").cast("string"))).alias("p"))
    return t.select("event_id", date_from_path("p", "DMY").alias("day_dmy"), date_from_path("p", "MDY").alias("day_mdy"))


@query("combine_date_time", """
SELECT event_id,
  CASE WHEN event_id % 6 IN (0, 1, 2) THEN date_trunc('minute', ts)
       WHEN event_id % 6 = 4 AND hour(ts) BETWEEN 1 AND 12 THEN date_trunc('minute', ts)
       ELSE NULL END AS ts_combined
FROM events""")
def q_combine(spark, sf):
    e = F.col("event_id")
    txt = (F.when(e % 6 == 0, F.date_format("ts", "h:mm a"))
           .when(e % 6 == 1, F.concat(F.date_format("ts", "h:mm"), F.lit(" "), F.date_format("ts", "a")))
           .when(e % 6 == 2, F.lower(F.date_format("ts", "h:mm a")))
           .when(e % 6 == 3, F.date_format("ts", "H:mm"))
           .when(e % 6 == 4, F.date_format("ts", "HH:mm a")))
    t = ev(spark, sf).select("event_id", F.to_date("ts").alias("d"), txt.alias("t"))
    return t.select("event_id", combine_date_time("d", "t").alias("ts_combined"))


@query("combine_date_time_multi", """
SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('minute', ts)
    ELSE date_trunc('second', ts) END AS ts_combined
FROM events""")
def q_combine_multi(spark, sf):
    e = F.col("event_id")
    txt = (F.when(e % 4 == 0, F.date_format("ts", "h:mm a"))
           .when(e % 4 == 1, F.date_format("ts", "HH:mm:ss"))
           .when(e % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .otherwise(F.date_format("ts", "H:mm")))
    t = ev(spark, sf).select("event_id", F.to_date("ts").alias("d"), txt.alias("t"))
    return t.select("event_id", combine_date_time_multi("d", "t").alias("ts_combined"))


ISO_TEXT_SPARK = """CASE event_id % 5
  WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || 'Z'
  WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || '+02:00'
  WHEN 2 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") || '-05:30'
  WHEN 3 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
  ELSE '2024' END"""


@query("iso_to_utc", """
SELECT event_id, CASE event_id % 5
  WHEN 0 THEN date_trunc('second', ts)
  WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
  WHEN 2 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE
  WHEN 3 THEN date_trunc('second', ts)
  ELSE NULL END AS ts_utc
FROM events""")
def q_iso_utc(spark, sf):
    t = ev(spark, sf).selectExpr("event_id", f"{ISO_TEXT_SPARK} AS raw")
    return t.select("event_id", iso_timestamp("raw", "convert").alias("ts_utc"))


@query("iso_drop_zone", """
SELECT event_id, CASE WHEN event_id % 5 < 4 THEN date_trunc('second', ts) END AS ts_wall
FROM events""")
def q_iso_drop(spark, sf):
    t = ev(spark, sf).selectExpr("event_id", f"{ISO_TEXT_SPARK} AS raw")
    return t.select("event_id", iso_timestamp("raw", "drop").alias("ts_wall"))


@query("ts_to_iso", """
SELECT event_id, CASE
  WHEN event_id % 2 = 1 OR epoch_us(ts) % 1000000 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso
FROM events""")
def q_ts_to_iso(spark, sf):
    t = ev(spark, sf).select("event_id", F.when(F.col("event_id") % 2 == 1,
                                                F.date_trunc("second", "ts").cast("timestamp_ntz"))
                             .otherwise(F.col("ts")).alias("t"))
    return t.select("event_id", ts_to_iso("t").alias("iso"))


# ===========================================================================
# Metrics over the typed observations

def obs(spark, sf):
    return S.observations(spark, sf)


_STORED: dict[tuple, str] = {}


def stored_obs(spark, sf):
    """The observations as a stored table (K7 layout), written once per session:
    the input of queries whose filters reach the scan."""
    from stratus.session import shared_dir
    from stratus.sinks.tables import write_layout
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        path = shared_dir(spark, "stored-obs")
        write_layout(obs(spark, sf), path, keep=("pos",))
        _STORED[key] = path
    return spark.read.parquet(_STORED[key]).select("pos", *UNIFIED_COLUMNS)


def _null_rate_sql(c: str, section: str | None = None) -> str:
    rate = f'round(CAST(count_if("{c}" IS NULL) AS DOUBLE) / count(*) * 100, 2)'
    if section is None:
        return f"SELECT '{c}' AS column_name, {rate} AS null_rate_pct FROM obs"
    return f"SELECT '{section}' AS section, '{c}' AS key, {rate} AS num, CAST(NULL AS VARCHAR) AS txt FROM obs"


NULL_RATES_SQL = "\nUNION ALL ".join(_null_rate_sql(c) for c in UNIFIED_COLUMNS)


@query("count_total", f"{OBS} SELECT count(*) AS total_records FROM obs")
def q_count_total(spark, sf):
    return Q.count_total(obs(spark, sf))


@query("count_by_source", f"{OBS} SELECT source, count(*) AS records FROM obs GROUP BY source")
def q_count_by_source(spark, sf):
    return Q.count_by(obs(spark, sf), "source")


@query("count_by_station", f"{OBS} SELECT station_id, count(*) AS records FROM obs GROUP BY station_id")
def q_count_by_station(spark, sf):
    return Q.count_by(obs(spark, sf), "station_id")


@query("time_span", f'{OBS} SELECT min("timestamp") AS ts_min, max("timestamp") AS ts_max FROM obs')
def q_time_span(spark, sf):
    return Q.time_span(obs(spark, sf))


@query("null_rates", f"{OBS} {NULL_RATES_SQL}")
def q_null_rates(spark, sf):
    return Q.null_rates(obs(spark, sf))


@query("high_null_columns", f"{OBS} SELECT * FROM ({NULL_RATES_SQL}) WHERE null_rate_pct > 50")
def q_high_null(spark, sf):
    return Q.high_null_columns(obs(spark, sf))


DUPS_SQL = 'SELECT count(*) AS n FROM obs GROUP BY station_id, "timestamp"'


@query("duplicates_all", f"{OBS} SELECT CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicates "
                         f"FROM ({DUPS_SQL})")
def q_dups_all(spark, sf):
    return D.duplicates_all(obs(spark, sf))


@query("duplicates_extra", f"{OBS} SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates FROM ({DUPS_SQL})")
def q_dups_extra(spark, sf):
    return D.duplicates_extra(obs(spark, sf))


@query("key_null_counts", f'{OBS} SELECT count_if("timestamp" IS NULL) AS invalid_timestamp, '
                          f"count_if(station_id IS NULL) AS missing_station_id FROM obs")
def q_key_nulls(spark, sf):
    return Q.key_null_counts(obs(spark, sf))


ANOMALY_SQL_LOCAL = """
SELECT 'Température min suspecte: ' || CAST(t_min AS VARCHAR) || '°C' AS anomaly FROM ext WHERE t_min < -50
UNION ALL SELECT 'Température max suspecte: ' || CAST(t_max AS VARCHAR) || '°C' FROM ext WHERE t_max > 60
UNION ALL SELECT 'Humidité > 100%: ' || CAST(h_max AS VARCHAR) FROM ext WHERE h_max > 100
UNION ALL SELECT 'Pression min suspecte: ' || CAST(p_min AS VARCHAR) || ' hPa' FROM ext WHERE p_min < 870"""
EXT_SQL = ("ext AS (SELECT min(temperature_c) AS t_min, max(temperature_c) AS t_max, "
           "max(humidity_pct) AS h_max, min(pressure_hpa) AS p_min FROM obs)")


@query("anomalies", f"{OBS}, {EXT_SQL} {ANOMALY_SQL_LOCAL}")
def q_anomalies(spark, sf):
    return Q.anomalies(obs(spark, sf), "local")


STRICT_REQ = RULESETS["strict"]["required"]
MISSING_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS field, count_if(\"{c}\" IS NULL) AS missing FROM obs" for c in STRICT_REQ)


@query("missing_required", f"{OBS} SELECT * FROM ({MISSING_SQL}) WHERE missing > 0")
def q_missing_required(spark, sf):
    return Q.missing_required(obs(spark, sf), STRICT_REQ)


MISS_SUM = " + ".join(f'count_if("{c}" IS NULL)' for c in STRICT_REQ)


@query("conformity_rate", f"{OBS} SELECT round(CAST(count(*) - ({MISS_SUM}) AS DOUBLE) / count(*) * 100, 2) "
                          f"AS conformity_pct FROM obs")
def q_conformity(spark, sf):
    return Q.conformity_rate(obs(spark, sf), STRICT_REQ)


@query("distinct_stations", f"{OBS} SELECT count(DISTINCT station_id) AS stations FROM obs")
def q_distinct_stations(spark, sf):
    return Q.distinct_stations(obs(spark, sf))


@query("station_temp_stats", f"""{OBS}
SELECT station_id, round(avg(CAST(temperature_c AS DECIMAL(38,10))), 4) AS avg_temp, min(temperature_c) AS min_temp,
  max(temperature_c) AS max_temp, count(*) AS "count"
FROM obs GROUP BY station_id""")
def q_station_temp(spark, sf):
    return QQ.station_temp_stats(obs(spark, sf)).withColumn("avg_temp", F.round("avg_temp", 4).cast("double"))


@query("share_by_source", f"""{OBS}
SELECT source, count(*) AS records, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 1) AS share_pct
FROM obs GROUP BY source""")
def q_share_source(spark, sf):
    return QQ.share_by(obs(spark, sf), "source")


@query("share_by_station", f"""{OBS}
SELECT station_id, count(*) AS records,
  round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 1) AS share_pct
FROM obs GROUP BY station_id""")
def q_share_station(spark, sf):
    return QQ.share_by(obs(spark, sf), "station_id")


def _ts_txt(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


QUALITY_LOCAL_SQL = f"""{OBS}, {EXT_SQL},
g AS (SELECT count(*) AS total, min("timestamp") AS tmin, max("timestamp") AS tmax,
  count_if("timestamp" IS NULL) AS ts_null, count_if(station_id IS NULL) AS sid_null FROM obs)
SELECT 'total_records' AS section, CAST(NULL AS VARCHAR) AS key, CAST(total AS DOUBLE) AS num,
  CAST(NULL AS VARCHAR) AS txt FROM g
UNION ALL SELECT 'date_range', 'min', NULL, {_ts_txt('tmin')} FROM g
UNION ALL SELECT 'date_range', 'max', NULL, {_ts_txt('tmax')} FROM g
UNION ALL {"UNION ALL ".join(_null_rate_sql(c, 'null_rates') + chr(10) for c in UNIFIED_COLUMNS)}
UNION ALL SELECT 'invalid_timestamp', NULL, ts_null, NULL FROM g
UNION ALL SELECT 'missing_station_id', NULL, sid_null, NULL FROM g
UNION ALL SELECT 'anomalies', NULL, NULL, anomaly FROM ({ANOMALY_SQL_LOCAL})
UNION ALL SELECT 'records_per_source', source, count(*), NULL FROM obs GROUP BY source
UNION ALL SELECT 'records_per_station', station_id, count(*), NULL FROM obs GROUP BY station_id
UNION ALL SELECT 'duplicates', NULL, COALESCE(SUM(n) FILTER (WHERE n > 1), 0), NULL FROM ({DUPS_SQL})"""


@query("quality_report", QUALITY_LOCAL_SQL)
def q_quality_report(spark, sf):
    return Q.quality_report(obs(spark, sf), "local")


POST_LOAD_SQL = f"""{OBS},
g AS (SELECT count(*) AS total, min("timestamp") AS tmin, max("timestamp") AS tmax FROM obs),
miss AS ({MISSING_SQL})
SELECT 'total_documents' AS section, CAST(NULL AS VARCHAR) AS key, CAST(total AS DOUBLE) AS num,
  CAST(NULL AS VARCHAR) AS txt FROM g
UNION ALL SELECT 'schema_conformity_rate_pct', NULL,
  round(CAST(total - (SELECT sum(missing) FROM miss) AS DOUBLE) / total * 100, 2), NULL FROM g
UNION ALL SELECT 'date_range', 'min', NULL, {_ts_txt('tmin')} FROM g
UNION ALL SELECT 'date_range', 'max', NULL, {_ts_txt('tmax')} FROM g
UNION ALL {"UNION ALL ".join(_null_rate_sql(c, 'null_rates_pct') + chr(10) for c in MEASURE_COLUMNS)}
UNION ALL SELECT 'missing_required_fields', field, missing, NULL FROM miss WHERE missing > 0
UNION ALL SELECT 'by_source', source, count(*), NULL FROM obs GROUP BY source"""


@query("post_load_report", POST_LOAD_SQL)
def q_post_load_report(spark, sf):
    return Q.post_load_report(obs(spark, sf), "strict")


# ===========================================================================
# W1, K8, P15-P17, T1, T4, P7, K5, K6

@query("dedup_keep_first", f"""{OBS}
SELECT pos, {U23} FROM obs QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY pos) = 1""")
def q_dedup(spark, sf):
    return D.dedup_keep_first(obs(spark, sf), ["station_id", "timestamp"], ["pos"])


@query("unique_key_violations", f"""{OBS}
SELECT station_id, "timestamp", count(*) AS n FROM obs GROUP BY station_id, "timestamp" HAVING count(*) > 1""")
def q_unique_viol(spark, sf):
    return D.unique_key_violations(obs(spark, sf))


@query("filter_station", f"{OBS} SELECT pos, {U23} FROM obs WHERE station_id = '7'")
def q_filter_station(spark, sf):
    return QQ.filter_station(stored_obs(spark, sf), "7")


@query("day_slice", f"""{OBS} SELECT pos, {U23} FROM obs
WHERE "timestamp" >= TIMESTAMP '2024-01-15 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-16 00:00:00'""")
def q_day_slice(spark, sf):
    return QQ.day_slice(stored_obs(spark, sf), dt.date(2024, 1, 15))


@query("strong_wind", f"{OBS} SELECT pos, {U23} FROM obs WHERE wind_speed_kmh > 50")
def q_strong_wind(spark, sf):
    return QQ.strong_wind(stored_obs(spark, sf), 50.0)


@query("latest_10", f"""{OBS} SELECT pos, {U23} FROM obs WHERE station_id = '7'
ORDER BY "timestamp" DESC NULLS LAST, pos DESC LIMIT 10""")
def q_latest_10(spark, sf):
    return QQ.latest_n(stored_obs(spark, sf), "7", 10, tie_break=[F.col("pos").desc()])


@query("sample_row", f"""{OBS} SELECT pos, {U23} FROM obs WHERE source = 'weather_underground'
ORDER BY station_id NULLS FIRST, "timestamp" NULLS FIRST, pos LIMIT 1""")
def q_sample_row(spark, sf):
    return QQ.sample_row(obs(spark, sf), "weather_underground", ["station_id", "timestamp", "pos"])


SPARSE = ["visibility_m", "cloud_cover_octas", "snow_depth_cm", "weather_code"]


@query("drop_all_null", f"""{OBS} SELECT pos, {", ".join(SPARSE)} FROM obs
WHERE NOT ({" AND ".join(f"{c} IS NULL" for c in SPARSE)})""")
def q_drop_all_null(spark, sf):
    from stratus.operators.normalize import drop_all_null
    return drop_all_null(obs(spark, sf).select("pos", *SPARSE), SPARSE)


@query("update_where", f"""{OBS} SELECT pos, station_id,
  CASE WHEN station_id = '3' THEN NULL ELSE temperature_c END AS temperature_c FROM obs""")
def q_update_where(spark, sf):
    from stratus.sinks.tables import update_where
    o = obs(spark, sf)
    out = update_where(o, F.col("station_id") == "3", {"temperature_c": F.lit(None).cast("double")})
    return out.select("pos", "station_id", "temperature_c")


@query("delete_where", f"{OBS} SELECT pos, source FROM obs WHERE source <> 'manual' OR source IS NULL")
def q_delete_where(spark, sf):
    from stratus.sinks.tables import delete_where
    return delete_where(obs(spark, sf), F.col("source") == "manual").select("pos", "source")


@query("upsert_by_key", f"""{OBS},
tgt AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY pos) = 1),
upd AS (SELECT pos, station_id, "timestamp", temperature_c + 100 AS temperature_c FROM obs
        WHERE station_type = 'view'
        QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY pos DESC) = 1)
SELECT pos, station_id, "timestamp", temperature_c FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.station_id IS NOT DISTINCT FROM tgt.station_id
                  AND upd."timestamp" IS NOT DISTINCT FROM tgt."timestamp")
UNION ALL SELECT pos, station_id, "timestamp", temperature_c FROM upd""")
def q_upsert(spark, sf):
    from stratus.sinks.tables import upsert
    o = obs(spark, sf).select("pos", "station_id", "timestamp", "temperature_c", "station_type")
    tgt = D.dedup_keep_first(o, ["station_id", "timestamp"], ["pos"]).drop("station_type")
    upd = (o.filter(F.col("station_type") == "view").drop("station_type")
           .withColumn("temperature_c", F.col("temperature_c") + 100))
    return upsert(tgt, upd, order="pos")


# ===========================================================================
# Station dimension joins

DIM_SQL = """dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS station_name, CAST(s_nationkey * 2.0 AS DOUBLE) AS latitude,
    s_acctbal / 1000 AS longitude, 10.0::DOUBLE AS elevation, 'synop' AS station_type, s_suppkey AS pos FROM supplier
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey * 10.0 AS DOUBLE), 5.0::DOUBLE, 20.0::DOUBLE, 'manual',
    n_nationkey + 10000000 FROM nation),
lastdim AS (SELECT * FROM dim QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY pos DESC) = 1)"""


@query("station_enrich", f"""{OBS}, {DIM_SQL}
SELECT o.pos, o.station_id, d.station_name, d.latitude, d.longitude, d.elevation, d.station_type
FROM obs o LEFT JOIN lastdim d ON o.station_id = d.station_id""")
def q_station_enrich(spark, sf):
    from stratus.operators.joins import enrich_stations
    out = enrich_stations(S.obs_for_join(spark, sf), S.stations_dim(spark, sf))
    return out.select("pos", "station_id", "station_name", "latitude", "longitude", "elevation", "station_type")


@query("station_enrich_default", f"""{OBS}, {DIM_SQL}
SELECT o.pos, o.station_id, CASE WHEN d.station_id IS NULL THEN 'Unknown_' || o.station_id ELSE d.station_name END
  AS station_name, d.latitude, d.longitude, d.elevation,
  CASE WHEN d.station_id IS NULL THEN 'weather_underground' ELSE d.station_type END AS station_type
FROM obs o LEFT JOIN lastdim d ON o.station_id = d.station_id""")
def q_station_enrich_default(spark, sf):
    from stratus.operators.joins import enrich_stations_default
    out = enrich_stations_default(S.obs_for_join(spark, sf), S.stations_dim(spark, sf))
    return out.select("pos", "station_id", "station_name", "latitude", "longitude", "elevation", "station_type")


# ===========================================================================
# Raw wrapped JSON-lines: S2, S6, P1, P8, P20, P2, P3, U1, E2

RAW_SQL = """WITH raw AS (
  SELECT *,
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'wu' WHEN event_type = 'purchase' THEN 'ic'
         ELSE 'misc' END AS kind,
    strftime(ts, '%d%m%y') AS day,
    CASE user_id % 3 WHEN 0 THEN 'BE' WHEN 1 THEN 'FR' ELSE 'NL' END AS country,
    event_id % 151 = 0 AS is_blank,
    (event_id % 151 <> 0 AND event_id % 149 = 0) AS is_bad
  FROM events),
raw2 AS (
  SELECT *, CASE kind WHEN 'wu' THEN '/raw/' || country || '/' || day || '/' || event_type || '.jsonl'
                      WHEN 'ic' THEN '/raw/infoclimat/' || day || '/hourly.jsonl'
                      ELSE '/raw/misc/' || day || '/log.json' END AS file_path
  FROM raw),
good AS (SELECT * FROM raw2 WHERE NOT is_blank AND NOT is_bad)"""

WU_COLS_SQL = """'weather_underground' AS source,
  CASE user_id % 3 WHEN 0 THEN 'IICHTE19' WHEN 1 THEN 'ILAMAD25' ELSE 'UNKNOWN' END AS station_id,
  CASE user_id % 3 WHEN 0 THEN 'WeerstationBS' WHEN 1 THEN 'La Madeleine' ELSE 'Unknown_UNKNOWN' END AS station_name,
  CAST(CASE user_id % 3 WHEN 0 THEN 51.092 WHEN 1 THEN 50.659 END AS DOUBLE) AS latitude,
  CAST(CASE user_id % 3 WHEN 0 THEN 2.999 WHEN 1 THEN 3.07 END AS DOUBLE) AS longitude,
  CAST(CASE user_id % 3 WHEN 0 THEN 15.0 WHEN 1 THEN 23.0 END AS DOUBLE) AS elevation,
  'weather_underground' AS station_type,
  date_trunc('minute', ts) AS "timestamp",
  round((value - 32) * 5 / 9, 2) AS temperature_c,
  round((CAST(printf('%.2f', value - 10) AS DOUBLE) - 32) * 5 / 9, 2) AS dew_point_c,
  CAST(event_id % 101 AS DOUBLE) AS humidity_pct,
  CASE WHEN event_id % 18 < 16 THEN (event_id % 18) * 22.5 END AS wind_direction_deg,
  round(CAST(CAST(event_id % 40 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) AS DOUBLE) * 1.60934, 2)
    AS wind_speed_kmh,
  CASE WHEN event_id % 4 <> 0 THEN round(CAST(CAST(event_id % 60 AS VARCHAR) || '.5' AS DOUBLE) * 1.60934, 2) END
    AS wind_gust_kmh,
  round(CAST(CAST(28 + event_id % 3 AS VARCHAR) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') AS DOUBLE)
    * 33.8639, 2) AS pressure_hpa,
  CASE WHEN event_id % 6 <> 0 THEN round(CAST('0.0' || CAST(event_id % 10 AS VARCHAR) AS DOUBLE) * 25.4, 2) END
    AS precip_rate_mm,
  round(CAST('0.' || lpad(CAST(event_id % 50 AS VARCHAR), 2, '0') AS DOUBLE) * 25.4, 2) AS precip_accum_mm,
  CAST(NULL AS DOUBLE) AS visibility_m, CAST(NULL AS DOUBLE) AS cloud_cover_octas,
  CAST(NULL AS DOUBLE) AS snow_depth_cm, CAST(NULL AS VARCHAR) AS weather_code,
  CAST(event_id % 11 AS DOUBLE) AS uv_index, CAST(event_id % 900 AS DOUBLE) AS solar_radiation_wm2"""

IC_COLS_SQL = """'infoclimat' AS source, CAST(user_id AS VARCHAR) AS station_id,
  CAST(NULL AS VARCHAR) AS station_name, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
  CAST(NULL AS DOUBLE) AS elevation, 'infoclimat_api' AS station_type,
  date_trunc('second', ts) AS "timestamp",
  value / 8 - 15 AS temperature_c, value / 10 - 20 AS dew_point_c,
  CAST(event_id % 100 AS DOUBLE) AS humidity_pct, CAST((event_id % 36) * 10 AS DOUBLE) AS wind_direction_deg,
  value / 7 AS wind_speed_kmh, CASE WHEN event_id % 5 <> 0 THEN value / 5 END AS wind_gust_kmh,
  CAST(980 + event_id % 60 AS DOUBLE) AS pressure_hpa,
  CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 7 AS DOUBLE) END AS precip_rate_mm,
  CASE WHEN event_id % 9 <> 0 THEN CAST(event_id % 9 AS DOUBLE) END AS precip_accum_mm,
  CASE WHEN event_id % 80 = 0 THEN CAST(event_id % 10000 AS DOUBLE) END AS visibility_m,
  CASE WHEN event_id % 200 = 0 THEN CAST(event_id % 9 AS DOUBLE) END AS cloud_cover_octas,
  CAST(NULL AS DOUBLE) AS snow_depth_cm,
  CASE WHEN event_id % 50 = 0 THEN CAST(event_id % 100 AS VARCHAR) END AS weather_code,
  CAST(NULL AS DOUBLE) AS uv_index, CAST(NULL AS DOUBLE) AS solar_radiation_wm2"""

PROJECTED_SQL = f"""projected AS (
  SELECT event_id AS row_id, file_path, {WU_COLS_SQL} FROM good WHERE kind = 'wu'
  UNION ALL
  SELECT event_id AS row_id, file_path, {IC_COLS_SQL} FROM good WHERE kind = 'ic')"""


def raw(spark, sf):
    return S.raw_lines(spark, sf)


def _records(spark, sf):
    from stratus.plans.pipelines import cloud_records
    return cloud_records(raw(spark, sf))


@query("parse_quarantine", f"""{RAW_SQL}
SELECT event_id AS row_id, 'invalid JSON' AS error,
  '{{"_airbyte_data": {{"Time": "' || strftime(ts, '%-I:%M') AS raw
FROM raw2 WHERE is_bad""")
def q_parse_quarantine(spark, sf):
    from stratus.sources.jsonl import nonblank, parse_records, quarantine
    return quarantine(parse_records(nonblank(raw(spark, sf)))).select("row_id", "error", "raw")


@query("rows_per_file", f"{RAW_SQL} SELECT file_path, count(*) AS records FROM good GROUP BY file_path")
def q_rows_per_file(spark, sf):
    from stratus.sources.jsonl import nonblank, parse_records, rows_per_file
    return rows_per_file(parse_records(nonblank(raw(spark, sf))))


@query("airbyte_unwrap", f"""{RAW_SQL}
SELECT event_id AS row_id, event_id % 7 <> 3 AS wrapped,
  CAST(CASE kind WHEN 'wu' THEN 12 WHEN 'ic' THEN 15 ELSE 2 END AS BIGINT) AS n_keys
FROM good""")
def q_unwrap(spark, sf):
    from stratus.operators.normalize import WRAPPER_KEY, unwrap
    from stratus.sources.jsonl import nonblank, parse_records
    p = parse_records(nonblank(raw(spark, sf))).filter(F.col("parse_error").isNull())
    return p.select("row_id", F.map_contains_key("rec", F.lit(WRAPPER_KEY)).alias("wrapped"),
                    F.size(unwrap("rec")).cast("long").alias("n_keys"))


@query("detect_source", f"""{RAW_SQL}
SELECT DISTINCT file_path, CASE kind WHEN 'wu' THEN 'weather_underground' WHEN 'ic' THEN 'infoclimat'
  ELSE 'unknown' END AS kind FROM good""")
def q_detect_source(spark, sf):
    return _records(spark, sf).select("file_path", "kind").distinct()


@query("infer_station", f"""{RAW_SQL}
SELECT DISTINCT file_path AS rel_path,
  CASE WHEN kind = 'wu' AND country = 'BE' THEN 'IICHTE19' WHEN kind = 'wu' AND country = 'FR' THEN 'ILAMAD25'
       ELSE 'UNKNOWN' END AS station_id
FROM raw2""")
def q_infer_station(spark, sf):
    from stratus.operators.normalize import infer_station
    return raw(spark, sf).select("rel_path").distinct().select("rel_path", infer_station("rel_path").alias("station_id"))


@query("infoclimat_project", f"{RAW_SQL} SELECT event_id AS row_id, {IC_COLS_SQL} FROM good WHERE kind = 'ic'")
def q_ic_project(spark, sf):
    from stratus.operators.normalize import infoclimat_columns, unified_select
    r = _records(spark, sf).filter(F.col("kind") == "infoclimat")
    return r.select("row_id", *unified_select(infoclimat_columns(F.col("payload"))))


@query("wu_project", f"{RAW_SQL} SELECT event_id AS row_id, {WU_COLS_SQL} FROM good WHERE kind = 'wu'")
def q_wu_project(spark, sf):
    from stratus.operators.normalize import infer_station, unified_select, wu_columns
    r = _records(spark, sf).filter(F.col("kind") == "weather_underground")
    cols = wu_columns(F.col("payload"), infer_station(F.col("rel_path")), date_from_path(F.col("rel_path")), "cloud")
    return r.select("row_id", *unified_select(cols))


@query("union_sources", f"{RAW_SQL}, {PROJECTED_SQL} SELECT row_id, {U23} FROM projected")
def q_union(spark, sf):
    from stratus.operators.normalize import union_sources
    ic = q_ic_project(spark, sf)
    wu = q_wu_project(spark, sf)
    return union_sources(ic, wu).select("row_id", *UNIFIED_COLUMNS)


@query("pipeline_cloud", f"""{RAW_SQL}, {PROJECTED_SQL}
SELECT row_id, {U23} FROM projected
QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY file_path, row_id) = 1""")
def q_pipeline_cloud(spark, sf):
    from stratus.plans.pipelines import cloud_transform
    return cloud_transform(raw(spark, sf)).select("row_id", *UNIFIED_COLUMNS)


@query("quality_report_cloud", f"""{RAW_SQL}, {PROJECTED_SQL},
obs AS (SELECT * FROM projected
        QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY file_path, row_id) = 1),
{EXT_SQL},
g AS (SELECT count(*) AS total, min("timestamp") AS tmin, max("timestamp") AS tmax FROM obs)
SELECT 'total_records' AS section, CAST(NULL AS VARCHAR) AS key, CAST(total AS DOUBLE) AS num,
  CAST(NULL AS VARCHAR) AS txt FROM g
UNION ALL SELECT 'date_range', 'min', NULL, {_ts_txt('tmin')} FROM g
UNION ALL SELECT 'date_range', 'max', NULL, {_ts_txt('tmax')} FROM g
UNION ALL {"UNION ALL ".join(_null_rate_sql(c, 'null_rates') + chr(10) for c in UNIFIED_COLUMNS)}
UNION ALL SELECT 'anomalies', NULL, NULL, 'Temp min: ' || CAST(t_min AS VARCHAR) || ' degC' FROM ext WHERE t_min < -50
UNION ALL SELECT 'anomalies', NULL, NULL, 'Temp max: ' || CAST(t_max AS VARCHAR) || ' degC' FROM ext WHERE t_max > 60
UNION ALL SELECT 'records_per_source', source, count(*), NULL FROM obs WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'records_per_station', station_id, count(*), NULL FROM obs WHERE station_id IS NOT NULL
  GROUP BY station_id
UNION ALL SELECT 'duplicates', NULL, COALESCE(SUM(n - 1), 0), NULL FROM ({DUPS_SQL})""")
def q_quality_cloud(spark, sf):
    from stratus.plans.pipelines import cloud_transform
    from stratus.session import cut_lineage
    # the report's branches read the stored transform output instead of
    # recomputing the transform once per branch
    return Q.quality_report(cut_lineage(cloud_transform(raw(spark, sf)), "transformed"), "cloud")


# ===========================================================================
# Load: S8, X13/X14, P9-P14, A15, A16, T5, K3, K4, E3

LOAD_SQL = f"""{OBS},
ln AS (
  SELECT *, pos AS row_id,
    pos % 307 = 0 AS is_blank,
    (pos % 307 <> 0 AND pos % 293 = 0) AS is_bad,
    station_name IS NULL AND pos % 2 = 0 AS name_absent,
    pos % 61 = 2 AND weather_code IS NULL AS code_numeric,
    CASE WHEN "timestamp" IS NULL THEN NULL WHEN pos % 41 = 4 THEN "timestamp"
         WHEN pos % 43 = 5 THEN "timestamp" - INTERVAL 2 HOUR WHEN pos % 47 = 6 THEN NULL
         ELSE "timestamp" END AS ts_conv
  FROM obs),
chk AS (
  SELECT *, concat_ws(', ',
      CASE WHEN name_absent THEN 'required:station_name' END,
      CASE WHEN station_id IS NULL THEN 'type:station_id' END,
      CASE WHEN station_name IS NULL AND NOT name_absent THEN 'type:station_name' END,
      CASE WHEN latitude < -90 THEN 'minimum:latitude' END,
      CASE WHEN latitude > 90 THEN 'maximum:latitude' END,
      CASE WHEN ts_conv IS NULL THEN 'type:timestamp' END,
      CASE WHEN temperature_c < -60 THEN 'minimum:temperature_c' END,
      CASE WHEN temperature_c > 60 THEN 'maximum:temperature_c' END,
      CASE WHEN humidity_pct > 100 THEN 'maximum:humidity_pct' END,
      CASE WHEN pressure_hpa < 870 THEN 'minimum:pressure_hpa' END,
      CASE WHEN code_numeric THEN 'type:weather_code' END,
      CASE WHEN source NOT IN ('infoclimat', 'weather_underground') THEN 'enum:source' END) AS viols
  FROM ln WHERE NOT is_blank AND NOT is_bad),
firsts AS (SELECT station_id, ts_conv, min(pos) AS first_pos FROM chk WHERE viols = '' GROUP BY station_id, ts_conv),
outcome AS (
  SELECT c.*, CASE WHEN c.viols <> '' THEN 'schema_validation'
                   WHEN c.pos <> f.first_pos THEN 'duplicate_key' END AS reject_type
  FROM chk c LEFT JOIN firsts f
    ON c.station_id IS NOT DISTINCT FROM f.station_id AND c.ts_conv IS NOT DISTINCT FROM f.ts_conv)"""

LOADED_COLS_SQL = ", ".join('ts_conv AS "timestamp"' if c == "timestamp" else c for c in UNIFIED_COLUMNS)


def _outcome(spark, sf):
    from stratus.plans.pipelines import load
    return load(S.unified_lines(spark, sf))


def _rules(spark, sf, *prefixes):
    o = _outcome(spark, sf).filter(F.col("parse_error").isNull())
    r = o.select("row_id", F.explode("violations").alias("rule"))
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.col("rule").startswith(p)
    return r.filter(cond)


def _rules_sql(*prefixes):
    like = " OR ".join(f"rule LIKE '{p}%'" for p in prefixes)
    return (f"{LOAD_SQL} SELECT row_id, rule FROM (SELECT row_id, unnest(string_split(viols, ', ')) AS rule "
            f"FROM chk WHERE viols <> '') WHERE {like}")


@query("validate_required", _rules_sql("required:"))
def q_validate_required(spark, sf):
    return _rules(spark, sf, "required:")


@query("validate_types", _rules_sql("type:"))
def q_validate_types(spark, sf):
    return _rules(spark, sf, "type:")


@query("validate_range", _rules_sql("minimum:", "maximum:"))
def q_validate_range(spark, sf):
    return _rules(spark, sf, "minimum:", "maximum:")


@query("validate_enum", _rules_sql("enum:"))
def q_validate_enum(spark, sf):
    return _rules(spark, sf, "enum:")


@query("validate_split", f"{LOAD_SQL} SELECT row_id, viols = '' AS accepted, viols AS violations FROM chk")
def q_validate_split(spark, sf):
    o = _outcome(spark, sf).filter(F.col("parse_error").isNull())
    return o.select("row_id", (F.size("violations") == 0).alias("accepted"),
                    F.array_join("violations", ", ").alias("violations"))


@query("classify_rejects", f"{LOAD_SQL} SELECT row_id, reject_type FROM outcome WHERE reject_type IS NOT NULL")
def q_classify(spark, sf):
    return _outcome(spark, sf).filter(F.col("reject_type").isNotNull()).select("row_id", "reject_type")


@query("reject_counts", f"""{LOAD_SQL} SELECT reject_type, count(*) AS errors FROM outcome
WHERE reject_type IS NOT NULL GROUP BY reject_type""")
def q_reject_counts(spark, sf):
    return QQ.reject_counts(_outcome(spark, sf).filter(F.col("reject_type").isNotNull()))


ACCOUNTING_SQL = f"""{LOAD_SQL}
SELECT (SELECT count(*) FROM ln WHERE NOT is_blank) AS total_lines,
  (SELECT count(*) FROM chk) AS total_parsed, (SELECT count(*) FROM chk) AS total_submitted,
  count_if(reject_type IS NULL) AS total_inserted, count_if(reject_type IS NOT NULL) AS total_errors,
  count_if(reject_type = 'schema_validation') AS schema_validation,
  count_if(reject_type = 'duplicate_key') AS duplicate_key
FROM outcome"""


@query("import_accounting", ACCOUNTING_SQL)
def q_accounting(spark, sf):
    from stratus.plans.pipelines import import_accounting
    return import_accounting(_outcome(spark, sf))


@query("reject_sample", f"""{LOAD_SQL}
SELECT row_id, reject_type, left(CASE WHEN viols <> '' THEN 'failed validation: ' || viols
  ELSE 'duplicate key: ' || station_id || ' ' || CAST(ts_conv AS VARCHAR) END, 250) AS message
FROM outcome WHERE reject_type IS NOT NULL ORDER BY pos LIMIT 15""")
def q_reject_sample(spark, sf):
    from stratus.plans.pipelines import rejection_messages
    r = rejection_messages(_outcome(spark, sf))
    return QQ.reject_sample(r, ["pos"], 15).select("row_id", "reject_type", "message")


@query("normalize_record", f"""{LOAD_SQL}
SELECT row_id, CASE WHEN solar_radiation_wm2 IS NULL THEN 'null' ELSE 'double' END AS solar_strict,
  CASE WHEN solar_radiation_wm2 IS NULL THEN 'null' WHEN pos % 3 = 0 THEN 'int' ELSE 'double' END AS solar_core
FROM chk""")
def q_normalize_record(spark, sf):
    from stratus.operators.validate import parse_documents, tags_sql, with_values
    from stratus.schema import WIDEN_CORE, WIDEN_STRICT
    from stratus.sources.jsonl import nonblank
    f = ["solar_radiation_wm2"]
    d = parse_documents(nonblank(S.unified_lines(spark, sf)), f).filter(F.col("parse_error").isNull()).select("row_id", "doc")
    tag = lambda widen: F.expr(f"{tags_sql(f, widen)}[0]")
    return with_values(d, f).select("row_id", tag(WIDEN_STRICT).alias("solar_strict"), tag(WIDEN_CORE).alias("solar_core"))


def _loaded_table(spark, sf, twice: bool = False):
    from stratus.plans.pipelines import run_load
    from stratus.session import shared_dir
    path = shared_dir(spark, "table")
    lines = S.unified_lines(spark, sf)
    run_load(spark, lines, path, "reset").collect()
    if twice:
        run_load(spark, lines, path, "append").collect()
    return spark.read.parquet(path).select(*UNIFIED_COLUMNS)


@query("load_overwrite", f"{LOAD_SQL} SELECT {LOADED_COLS_SQL} FROM outcome WHERE reject_type IS NULL")
def q_load_overwrite(spark, sf):
    return _loaded_table(spark, sf)


@query("load_insert_ignore", f"{LOAD_SQL} SELECT {LOADED_COLS_SQL} FROM outcome WHERE reject_type IS NULL")
def q_load_insert_ignore(spark, sf):
    return _loaded_table(spark, sf, twice=True)


PIPELINE_LOAD_SQL = f"""{LOAD_SQL},
acct AS ({ACCOUNTING_SQL.replace(LOAD_SQL, "")}),
tbl AS (SELECT {LOADED_COLS_SQL} FROM outcome WHERE reject_type IS NULL),
g AS (SELECT count(*) AS total, min("timestamp") AS tmin, max("timestamp") AS tmax FROM tbl)
SELECT 'import' AS section, k AS key, CAST(v AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS txt FROM (
  SELECT 'total_lines' AS k, total_lines AS v FROM acct UNION ALL SELECT 'total_parsed', total_parsed FROM acct
  UNION ALL SELECT 'total_submitted', total_submitted FROM acct UNION ALL SELECT 'total_inserted', total_inserted FROM acct
  UNION ALL SELECT 'total_errors', total_errors FROM acct
  UNION ALL SELECT 'schema_validation', schema_validation FROM acct
  UNION ALL SELECT 'duplicate_key', duplicate_key FROM acct)
UNION ALL SELECT 'total_documents', NULL, total, NULL FROM g
UNION ALL SELECT 'schema_conformity_rate_pct', NULL, 100.0, NULL FROM g
UNION ALL SELECT 'date_range', 'min', NULL, {_ts_txt('tmin')} FROM g
UNION ALL SELECT 'date_range', 'max', NULL, {_ts_txt('tmax')} FROM g
UNION ALL {"UNION ALL ".join(_null_rate_sql(c, 'null_rates_pct').replace('FROM obs', 'FROM tbl') + chr(10)
                             for c in MEASURE_COLUMNS)}
UNION ALL SELECT 'by_source', source, count(*), NULL FROM tbl GROUP BY source"""


@query("pipeline_load", PIPELINE_LOAD_SQL)
def q_pipeline_load(spark, sf):
    from stratus.plans.pipelines import run_load
    from stratus.session import shared_dir
    return run_load(spark, S.unified_lines(spark, sf), shared_dir(spark, "table"), "reset")


@query("post_load_check", f"""{OBS},
g AS (SELECT count(*) AS total, min("timestamp") AS tmin, max("timestamp") AS tmax FROM obs),
s AS (SELECT * FROM obs WHERE source = 'weather_underground'
      ORDER BY {", ".join(f'"{c}" NULLS FIRST' for c in UNIFIED_COLUMNS)} LIMIT 1)
SELECT 'total_documents' AS section, CAST(NULL AS VARCHAR) AS key, CAST(total AS DOUBLE) AS num,
  CAST(NULL AS VARCHAR) AS txt FROM g
UNION ALL SELECT 'date_range', 'min', NULL, {_ts_txt('tmin')} FROM g
UNION ALL SELECT 'date_range', 'max', NULL, {_ts_txt('tmax')} FROM g
UNION ALL SELECT 'by_source', source, count(*), NULL FROM obs GROUP BY source
UNION ALL SELECT 'by_station', station_id, count(*), NULL FROM obs GROUP BY station_id
UNION ALL SELECT 'sample', 'station_id', NULL, station_id FROM s
UNION ALL SELECT 'sample', 'temperature_c', temperature_c, NULL FROM s
UNION ALL SELECT 'sample', 'timestamp', NULL, {_ts_txt('"timestamp"')} FROM s""")
def q_post_load_check(spark, sf):
    from stratus.plans.pipelines import post_load_check
    return post_load_check(obs(spark, sf).drop("pos"))


# ===========================================================================
# Files: S1, S3, S7, S8, K1, K7

@query("scan_jsonl", f"""{RAW_SQL}
SELECT '/a=' || CASE kind WHEN 'wu' THEN country WHEN 'ic' THEN 'infoclimat' ELSE 'misc' END || '/b=' || day AS folder,
  count(*) AS lines, count_if(NOT is_blank) AS nonblank_lines
FROM raw2 GROUP BY folder""")
def q_scan_jsonl(spark, sf):
    from stratus.session import shared_dir
    from stratus.sources.jsonl import scan_lines
    from stratus.functions.text import is_blank
    root = shared_dir(spark, "raw")
    r = raw(spark, sf)
    (r.select("value", F.regexp_extract("file_path", r"^/raw/([^/]+)/", 1).alias("a"),
              F.regexp_extract("file_path", r"^/raw/[^/]+/(\d{6})/", 1).alias("b"))
     .write.partitionBy("a", "b").text(root))
    lines = scan_lines(spark, root, glob="*.txt")
    folder = F.regexp_extract("rel_path", r"^(.*)/[^/]+$", 1)
    return (lines.groupBy(folder.alias("folder"))
            .agg(F.count(F.lit(1)).alias("lines"), F.count_if(~is_blank("value")).alias("nonblank_lines")))


@query("scan_prefix", """
SELECT '/json/event_type=' || event_type AS folder, count(*) AS lines FROM events GROUP BY event_type""")
def q_scan_prefix(spark, sf):
    from stratus.session import shared_dir
    from stratus.sources.jsonl import scan_lines
    root = shared_dir(spark, "prefix")
    e = ev(spark, sf).select("event_id", "event_type", "value")
    e.write.partitionBy("event_type").json(f"{root}/json")
    e.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/txt")
    lines = scan_lines(spark, root)  # default suffix filter: .jsonl / .json, all levels
    folder = F.regexp_extract("rel_path", r"^(.*)/[^/]+$", 1)
    return lines.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("lines"))


def _written_obs(spark, sf):
    from stratus.session import shared_dir
    from stratus.sinks.tables import write_layout
    path = shared_dir(spark, "obs")
    write_layout(obs(spark, sf), path)
    return path


@query("scan_table", f"{OBS} SELECT {U23} FROM obs")
def q_scan_table(spark, sf):
    from stratus.sinks.tables import scan_table
    return scan_table(spark, _written_obs(spark, sf))


@query("layout_scan", f"""{OBS} SELECT {U23} FROM obs WHERE station_id = '7'
AND "timestamp" >= TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-20 00:00:00'""")
def q_layout_scan(spark, sf):
    from stratus.sinks.tables import scan_table
    t = scan_table(spark, _written_obs(spark, sf))
    ts = F.col("timestamp")
    return t.filter((F.col("station_id") == "7")
                    & (ts >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
                    & (ts < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")))


EXPORT_COLS_SQL = ", ".join(
    "CASE WHEN pos % 37 = 0 OR pos % 41 = 0 THEN NULL ELSE _v / 8 - 15 END AS temperature_c" if c == "temperature_c"
    else "CASE WHEN pos % 43 = 0 THEN NULL ELSE _v / 7 END AS wind_speed_kmh" if c == "wind_speed_kmh"
    else f'"{c}"' for c in UNIFIED_COLUMNS)


@query("export_jsonl_roundtrip", f"""WITH obs AS (SELECT {S.obs_select_sql('duck')}, value AS _v FROM events)
SELECT {EXPORT_COLS_SQL} FROM obs""")
def q_export_roundtrip(spark, sf):
    from stratus.session import shared_dir
    from stratus.sinks.tables import export_jsonl, read_unified
    path = shared_dir(spark, "export")
    export_jsonl(S.observations_nonfinite(spark, sf), path)
    return read_unified(spark, path)


@query("read_unified", f"{OBS} SELECT {U23} FROM obs")
def q_read_unified(spark, sf):
    from stratus.session import shared_dir
    from stratus.sinks.tables import export_jsonl, read_unified
    path = shared_dir(spark, "export")
    export_jsonl(obs(spark, sf), path)
    return read_unified(spark, path)


# ===========================================================================
# Local transform: S4, S5, E1

DOC_ROWS_SQL = """SELECT 'infoclimat' AS source, CAST(user_id AS VARCHAR) AS station_id,
  CASE WHEN user_id % 5 <> 4 THEN 'Station ' || CAST(user_id AS VARCHAR) END AS station_name,
  CASE WHEN user_id % 5 <> 4 THEN 42.0 + CAST(user_id % 90 AS DOUBLE) / 10 END AS latitude,
  CASE WHEN user_id % 5 <> 4 THEN -4.0 + CAST(user_id % 80 AS DOUBLE) / 8 END AS longitude,
  CASE WHEN user_id % 5 <> 4 THEN CAST(user_id % 400 AS DOUBLE) END AS elevation,
  CASE WHEN user_id % 5 <> 4 THEN 'synop' END AS station_type,
  CASE WHEN event_id % 29 <> 0 THEN date_trunc('second', ts) END AS "timestamp",
  CASE WHEN event_id % 31 <> 0 THEN value / 8 - 15 END AS temperature_c,
  value / 10 - 20 AS dew_point_c, CAST(event_id % 100 AS DOUBLE) AS humidity_pct,
  CAST((event_id % 36) * 10 AS DOUBLE) AS wind_direction_deg, value / 7 AS wind_speed_kmh,
  CAST(NULL AS DOUBLE) AS wind_gust_kmh, CAST(980 + event_id % 60 AS DOUBLE) AS pressure_hpa,
  CAST(NULL AS DOUBLE) AS precip_rate_mm, CAST(NULL AS DOUBLE) AS precip_accum_mm,
  CAST(NULL AS DOUBLE) AS visibility_m, CAST(NULL AS DOUBLE) AS cloud_cover_octas,
  CAST(NULL AS DOUBLE) AS snow_depth_cm,
  CASE WHEN event_id % 50 = 0 THEN CAST(event_id % 100 AS VARCHAR) END AS weather_code,
  CAST(NULL AS DOUBLE) AS uv_index, CAST(NULL AS DOUBLE) AS solar_radiation_wm2
FROM events"""

SHEET_ROWS_SQL = """SELECT 'weather_underground' AS source,
  CASE WHEN user_id % 4 = 0 THEN 'IICHTE19' ELSE 'ILAMAD25' END AS station_id,
  CASE WHEN user_id % 4 = 0 THEN 'WeerstationBS' ELSE 'La Madeleine' END AS station_name,
  CASE WHEN user_id % 4 = 0 THEN 51.092 ELSE 50.659 END::DOUBLE AS latitude,
  CASE WHEN user_id % 4 = 0 THEN 2.999 ELSE 3.07 END::DOUBLE AS longitude,
  CASE WHEN user_id % 4 = 0 THEN 15.0 ELSE 23.0 END::DOUBLE AS elevation,
  'weather_underground' AS station_type,
  CASE WHEN event_id % 3 = 0 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS "timestamp",
  round((value - 32) * 5 / 9, 2) AS temperature_c, CAST(NULL AS DOUBLE) AS dew_point_c,
  CAST(event_id % 101 AS DOUBLE) AS humidity_pct,
  CASE WHEN event_id % 18 < 16 THEN (event_id % 18) * 22.5 END AS wind_direction_deg,
  round(CAST(CAST(event_id % 40 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) AS DOUBLE) * 1.60934, 2)
    AS wind_speed_kmh,
  CAST(NULL AS DOUBLE) AS wind_gust_kmh,
  round(CAST(CAST(28 + event_id % 3 AS VARCHAR) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') AS DOUBLE)
    * 33.8639, 2) AS pressure_hpa,
  round(CAST('0.0' || CAST(event_id % 10 AS VARCHAR) AS DOUBLE) * 25.4, 2) AS precip_rate_mm,
  CAST(NULL AS DOUBLE) AS precip_accum_mm, CAST(NULL AS DOUBLE) AS visibility_m,
  CAST(NULL AS DOUBLE) AS cloud_cover_octas, CAST(NULL AS DOUBLE) AS snow_depth_cm,
  CAST(NULL AS VARCHAR) AS weather_code, CAST(event_id % 11 AS DOUBLE) AS uv_index,
  CAST(NULL AS DOUBLE) AS solar_radiation_wm2
FROM events WHERE event_id % 23 <> 0"""


@query("infoclimat_explode", DOC_ROWS_SQL)
def q_ic_explode(spark, sf):
    from stratus.sources.document import explode_documents
    return explode_documents(S.documents(spark, sf)).select(*UNIFIED_COLUMNS)


def _sheet_rows(spark, sf):
    from stratus.operators.normalize import sheet_rows
    from stratus.sources.jsonl import nonblank, parse_records
    p = parse_records(nonblank(S.sheet_lines(spark, sf))).filter(F.col("parse_error").isNull())
    p = p.withColumnRenamed("rec", "payload")
    station = F.regexp_extract(F.col("file_path"), r"([^/]+)/[^/]+$", 1)
    return sheet_rows(p, station, "payload")


@query("wu_sheet_rows", SHEET_ROWS_SQL)
def q_sheet_rows(spark, sf):
    return _sheet_rows(spark, sf).select(*UNIFIED_COLUMNS)


@query("pipeline_local", f"{DOC_ROWS_SQL}\nUNION ALL\n{SHEET_ROWS_SQL}")
def q_pipeline_local(spark, sf):
    from stratus.plans.pipelines import local_transform
    return local_transform(S.documents(spark, sf), S.sheet_lines(spark, sf)).select(*UNIFIED_COLUMNS)


@query("parse_error_sample", f"""{RAW_SQL}
SELECT event_id AS row_id, 'invalid JSON' AS error,
  '{{"_airbyte_data": {{"Time": "' || strftime(ts, '%-I:%M') AS raw
FROM raw2 WHERE is_bad ORDER BY file_path, event_id LIMIT 10""")
def q_parse_error_sample(spark, sf):
    """T5 (parse side): the first 10 unparseable lines in input order, raw text cut to 200."""
    from stratus.sources.jsonl import ORDER, nonblank, parse_records, quarantine
    q = quarantine(parse_records(nonblank(raw(spark, sf))), raw_chars=200)
    return q.orderBy(*ORDER).limit(10).select("row_id", "error", "raw")


# ===========================================================================
# Quarantines, frequency tables, edits of two fields

@query("payload_quarantine", """
SELECT event_id AS row_id, 'payload is not an object' AS error FROM events
WHERE event_id % 151 <> 0 AND event_id % 149 <> 0 AND (event_id % 17 = 0 OR event_id % 19 = 0)""")
def q_payload_quarantine(spark, sf):
    """Wrappers whose payload is null or a number, among the raw lines."""
    from stratus.operators.normalize import payload_quarantine
    from stratus.sources.jsonl import nonblank, parse_records
    eid = F.col("row_id")
    line = (F.when((eid % 151 == 0) | (eid % 149 == 0), F.col("value"))
            .when(eid % 17 == 0, '{"_airbyte_data": null}').when(eid % 19 == 0, '{"_airbyte_data": 5}').otherwise(F.col("value")))
    parsed = parse_records(nonblank(raw(spark, sf).withColumn("value", line)))
    return payload_quarantine(parsed).select("row_id", "error")


@query("trailing_text", """
SELECT event_id AS row_id, 'invalid JSON' AS error FROM events
WHERE event_id % 151 <> 0 AND (event_id % 149 = 0 OR event_id % 23 IN (1, 2, 3))""")
def q_trailing_text(spark, sf):
    """A line is one object; text or a second object behind it is an error."""
    from stratus.sources.jsonl import nonblank, parse_records, quarantine
    eid, value = F.col("row_id"), F.col("value")
    more = F.when(eid % 23 == 1, " trailing").when(eid % 23 == 2, '{"a": 2}').when(eid % 23 == 3, ', {"a": [1]}').otherwise("")
    lines = raw(spark, sf).withColumn("value", F.when(eid % 151 == 0, value).otherwise(F.concat(value, more)))
    return quarantine(parse_records(nonblank(lines))).select("row_id", "error")


@query("document_quarantine", """
WITH docs AS (SELECT DISTINCT user_id, strftime(ts, '%Y%m%d') AS day FROM events)
SELECT '/docs/' || user_id || '_' || day || '.json' AS file_path,
  CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS station_key, CASE WHEN user_id % 7 = 1 THEN 0 END::INT AS rec_pos,
  CASE user_id % 7 WHEN 0 THEN 'invalid document' WHEN 1 THEN 'record is not an object' ELSE 'records are not a list' END AS error
FROM docs WHERE user_id % 7 <= 2""")
def q_document_quarantine(spark, sf):
    """Truncated documents, records that are no objects, records that are no list."""
    from stratus.sources.document import document_quarantine
    user = F.regexp_extract("file_path", r"/(\d+)_", 1).cast("long")
    value = F.col("value")
    docs = S.documents(spark, sf).withColumn("value", F.when(user % 7 == 0, F.expr("left(value, length(value) - 3)"))
                                             .when(user % 7 == 1, F.regexp_replace(value, r'": \[\{"event_id"', '": [5, {"event_id"'))
                                             .when(user % 7 == 2, F.regexp_replace(value, r'": \[\{"event_id".*\}\], "_params"', '": {"a": 1}, "_params"'))
                                             .otherwise(value))
    return document_quarantine(docs).select("file_path", "station_key", "rec_pos", "error")


@query("frequency_by_source", f"{OBS} SELECT source, count(*) AS records FROM obs GROUP BY source ORDER BY records DESC, source")
def q_frequency(spark, sf):
    return QQ.frequency_table(obs(spark, sf), "source")


@query("update_two_fields", f"""{OBS} SELECT pos, CASE WHEN station_id = '3' THEN 'b' ELSE station_id END AS station_id,
  CASE WHEN station_id = '3' THEN 0.0 ELSE temperature_c END AS temperature_c FROM obs""")
def q_update_two(spark, sf):
    """K6: predicate and values see the row as it was."""
    from stratus.sinks.tables import update_where
    out = update_where(obs(spark, sf), F.col("station_id") == "3", {"station_id": "b", "temperature_c": 0.0})
    return out.select("pos", "station_id", "temperature_c")


# ===========================================================================
# E3, cloud form: rule set core, offsets dropped, its own type names

LOAD_CORE_SQL = (LOAD_SQL
                 .replace('"timestamp" - INTERVAL 2 HOUR', '"timestamp"')
                 .replace("CASE WHEN name_absent THEN 'required:station_name' END,", "")
                 .replace("CASE WHEN station_name IS NULL AND NOT name_absent THEN 'type:station_name' END,", "")
                 .replace("CASE WHEN latitude < -90 THEN 'minimum:latitude' END,", "")
                 .replace("CASE WHEN latitude > 90 THEN 'maximum:latitude' END,",
                          "CASE WHEN solar_radiation_wm2 IS NOT NULL AND pos % 3 = 0 THEN 'type:solar_radiation_wm2' END,")
                 .replace("'schema_validation'", "'validation'").replace("'duplicate_key'", "'duplicate'"))


@query("import_accounting_cloud", f"""{LOAD_CORE_SQL}
SELECT (SELECT count(*) FROM ln WHERE NOT is_blank) AS total_lines,
  (SELECT count(*) FROM chk) AS total_parsed, (SELECT count(*) FROM chk) AS total_submitted,
  count_if(reject_type IS NULL) AS total_inserted, count_if(reject_type IS NOT NULL) AS total_errors,
  count_if(reject_type = 'validation') AS validation, count_if(reject_type = 'duplicate') AS duplicate, 0::BIGINT AS other
FROM outcome""")
def q_accounting_cloud(spark, sf):
    from stratus.plans.pipelines import import_accounting, load
    return import_accounting(load(S.unified_lines(spark, sf), "core", "drop", names="cloud"), "cloud")


@query("pipeline_load_cloud", f"""{LOAD_CORE_SQL},
tbl AS (SELECT {LOADED_COLS_SQL} FROM outcome WHERE reject_type IS NULL),
g AS (SELECT count(*) AS total, min("timestamp") AS tmin, max("timestamp") AS tmax FROM tbl)
SELECT 'total_documents' AS section, CAST(NULL AS VARCHAR) AS key, CAST(total AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS txt FROM g
UNION ALL SELECT 'date_range', 'min', NULL, {_ts_txt('tmin')} FROM g
UNION ALL SELECT 'date_range', 'max', NULL, {_ts_txt('tmax')} FROM g
UNION ALL SELECT 'by_source', source, count(*), NULL FROM tbl GROUP BY source
UNION ALL SELECT 'by_station', station_id, count(*), NULL FROM tbl GROUP BY station_id""")
def q_pipeline_load_cloud(spark, sf):
    """E3, cloud form, into a fresh table by append: its post-load sections."""
    from stratus.plans.pipelines import run_load
    from stratus.session import shared_dir
    report = run_load(spark, S.unified_lines(spark, sf), shared_dir(spark, "table"), "append", "core", "drop", "cloud")
    return report.where("section <> 'import'")


# ===========================================================================
# E2 on files: scan, transform, export, report

def _land(spark, frame, root: str, sep: str = "\n") -> None:
    """Files from rows (path, place, value), ``sep`` behind each: one folder of parts per path, moved to
    ``root``/path; a path whose rows were dealt over several tasks keeps every part."""
    from stratus.session import shared_dir
    parts = shared_dir(spark, "landing")
    lines = frame.withColumn("dir", F.replace(F.regexp_replace("path", "^/", ""), F.lit("/"), F.lit("__")))
    (lines.repartition("dir").sortWithinPartitions("dir", "place").select("dir", "value").write.option("lineSep", sep).partitionBy("dir").text(parts))
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(hadoop.Path(parts)):
        name = status.getPath().getName()
        if name.startswith("dir="):
            target = f"{root}/" + name[4:].replace("__", "/")
            fs.mkdirs(hadoop.Path(target).getParent())
            stem, _, suffix = target.rpartition(".")
            for i, part in enumerate(f for f in fs.listStatus(status.getPath()) if f.getPath().getName().startswith("part-")):
                fs.rename(part.getPath(), hadoop.Path(target if not i else f"{stem}-{i}.{suffix}"))


def _landed_files(spark, sf) -> str:
    """The raw lines as files under a fresh folder, one per path of the stand-in."""
    from stratus.session import shared_dir
    root = shared_dir(spark, "landed") + "/in raw"
    path = F.concat(F.regexp_replace("file_path", r"^/raw|\.jsonl?$", ""), F.lit(".jsonl"))
    _land(spark, raw(spark, sf).select(path.alias("path"), F.col("row_id").alias("place"), "value"), root)
    return root


@query("job_cloud", f"""{RAW_SQL}, {PROJECTED_SQL}
SELECT {U23} FROM projected
QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY file_path, row_id) = 1""")
def q_job_cloud(spark, sf):
    """E2 as users run it: files below a root (with a blank in its name) to a JSON-lines export."""
    from stratus.plans.pipelines import run_cloud
    from stratus.session import shared_dir
    return run_cloud(spark, _landed_files(spark, sf), shared_dir(spark, "cloud-out"))


@query("job_local", f"{DOC_ROWS_SQL}\nUNION ALL\n{SHEET_ROWS_SQL}")
def q_job_local(spark, sf):
    """E1 as users run it: document files and sheet files to a JSON-lines export, read back."""
    from stratus.plans.pipelines import run_local
    from stratus.session import shared_dir
    root = shared_dir(spark, "landed")
    # one document per day, with all stations of that day: its texts are landed one behind the other
    pieces = S.documents(spark, sf).select(
        F.regexp_extract("file_path", r"_(\d+)\.json", 1).alias("day"), F.col("file_path").alias("at"), (~F.startswith("value", F.lit('{"stations": [],'))).alias("has"),
        F.regexp_extract("value", r'^\{"stations": \[(.*)\], "hourly": \{', 1).alias("stations"),
        F.regexp_extract("value", r', "hourly": \{(.*), "_params"', 1).alias("hourly"))
    has = F.col("has")
    days = pieces.filter("day is not null").groupBy("day").agg(F.min(F.when(has, F.col("at"))).alias("first"))
    text = lambda part, at, value: F.struct(F.lit(part).alias("part"), at.alias("at"), value.alias("value"))
    own = F.array_compact(F.array(F.when(has, text(1, F.col("at"), F.concat(F.when(F.col("at") == F.col("first"), "").otherwise(", "), "stations"))),
                                  F.when(F.col("hourly") != "", text(3, F.col("at"), F.concat("hourly", F.lit(","))))))
    frame = [text(i, F.lit(""), F.lit(t)) for i, t in ((0, '{"stations": ['), (2, '], "hourly": {'), (4, '"_params": {"unit": "metric"}}}'))]
    texts = pieces.join(days, "day").select("day", F.inline(own)).unionByName(days.select("day", F.inline(F.array(*frame))))
    _land(spark, texts.select(F.concat(F.lit("/docs/"), "day", F.lit(".json")).alias("path"), F.struct("part", "at").alias("place"), "value"), root, sep=" ")
    _land(spark, S.sheet_lines(spark, sf).select(F.col("file_path").alias("path"), F.col("row_id").alias("place"), "value"), root)
    return run_local(spark, f"{root}/docs", f"{root}/sheets", shared_dir(spark, "local-out"))


@query("numeric_weather_code", f"""{RAW_SQL}, {PROJECTED_SQL},
kept AS (SELECT * FROM projected QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY file_path, row_id) = 1)
SELECT station_id, "timestamp", weather_code, row_id % 100 = 0 AS is_number,
  CASE WHEN row_id % 100 = 0 THEN 'type:weather_code' ELSE '' END AS violations
FROM kept WHERE weather_code IS NOT NULL""")
def q_numeric_code(spark, sf):
    """A weather code that came as a JSON number is one in the export, which the loader rejects."""
    from stratus.operators.validate import normalize_documents, parse_documents
    from stratus.plans.pipelines import cloud_transform
    from stratus.session import shared_dir
    from stratus.sinks.tables import export_jsonl
    number = F.regexp_replace("value", r'"temps_omm": ?"(\d+)"', r'"temps_omm":$1')
    lines = raw(spark, sf).withColumn("value", F.when(F.col("row_id") % 100 == 0, number).otherwise(F.col("value")))
    path = shared_dir(spark, "codes")
    export_jsonl(cloud_transform(lines), path)
    written = spark.read.text(path).filter(~F.col("value").contains('"weather_code":null'))
    docs = parse_documents(written).withColumn("is_number", ~F.col("value").contains('"weather_code":"')).withColumn(
        "code", F.regexp_extract("value", r'"weather_code":"?(\w+)', 1))
    rows = normalize_documents(docs, "core", "drop", keep=("is_number", "code"))
    broken = F.array_join(F.filter("violations", lambda v: v.contains("weather_code")), ", ")
    return rows.select("station_id", "timestamp", F.col("code").alias("weather_code"), "is_number", broken.alias("violations"))


@query("missing_sheet_columns", """
WITH sheets AS (
  SELECT '/sheets/' || CASE WHEN user_id % 4 = 0 THEN 'IICHTE19' ELSE 'ILAMAD25' END || '/' || strftime(ts, '%d%m%y') || '.jsonl' AS file_path,
    bool_or(user_id % 5 <> 0) AS has_gust
  FROM events WHERE event_id % 23 <> 0 GROUP BY file_path)
SELECT file_path, CASE WHEN has_gust THEN 'Dew Point, Precip. Accum.' ELSE 'Dew Point, Gust, Precip. Accum.' END AS missing FROM sheets""")
def q_missing_columns(spark, sf):
    """P5: the required columns that a sheet's rows lack."""
    from stratus.operators.normalize import missing_sheet_columns
    from stratus.sources.jsonl import nonblank, parse_records
    gust = F.when((F.col("row_id") % 23 != 0) & F.col("gusty"), F.regexp_replace("value", r"\}$", ',"Gust": null}')).otherwise(F.col("value"))
    users = ev(spark, sf).select(F.col("event_id").alias("row_id"), (F.col("user_id") % 5 != 0).alias("gusty"))
    lines = S.sheet_lines(spark, sf).join(users, "row_id").withColumn("value", gust)
    records = parse_records(nonblank(lines)).filter(F.col("parse_error").isNull()).withColumnRenamed("rec", "payload")
    return missing_sheet_columns(records).select("file_path", F.array_join("missing", ", ").alias("missing"))


@query("parse_error_lines", f"""{LOAD_SQL},
numbered AS (SELECT *, row_number() OVER (ORDER BY pos) AS line FROM ln)
SELECT line, 'invalid JSON' AS error, '{{"source": "infoclimat", "station_id": ' AS raw FROM numbered WHERE is_bad ORDER BY line LIMIT 10""")
def q_parse_error_lines(spark, sf):
    """The first ten lines that the loader could not parse, with their line numbers."""
    from stratus.plans.pipelines import parse_error_sample
    return parse_error_sample(S.unified_lines(spark, sf), _outcome(spark, sf)).select("line", "error", "raw")


@query("load_report_json", f"""{LOAD_SQL},
acct AS ({ACCOUNTING_SQL.replace(LOAD_SQL, "")}),
tbl AS (SELECT {LOADED_COLS_SQL} FROM outcome WHERE reject_type IS NULL)
SELECT 'import.total_lines' AS key, CAST(total_lines AS VARCHAR) AS value FROM acct
UNION ALL SELECT 'import.total_errors', CAST(total_errors AS VARCHAR) FROM acct
UNION ALL SELECT 'import.error_types.schema_validation', CAST(schema_validation AS VARCHAR) FROM acct WHERE schema_validation > 0
UNION ALL SELECT 'import.error_types.duplicate_key', CAST(duplicate_key AS VARCHAR) FROM acct WHERE duplicate_key > 0
UNION ALL SELECT 'import.errors_sample.' || row_id, reject_type FROM (SELECT * FROM outcome WHERE reject_type IS NOT NULL ORDER BY pos LIMIT 15)
UNION ALL SELECT 'import.parse_errors_sample.' || line, 'invalid JSON' FROM (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY pos) AS line FROM ln) WHERE is_bad ORDER BY line LIMIT 10)
UNION ALL SELECT 'quality.total_documents', CAST(count(*) AS VARCHAR) FROM tbl
UNION ALL SELECT 'quality.by_source.' || source, CAST(count(*) AS VARCHAR) FROM tbl GROUP BY source
UNION ALL SELECT 'quality.date_range.min', strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') FROM tbl""")
def q_load_report_json(spark, sf):
    """The loader's JSON report with both samples, read back from its file."""
    from stratus.plans.pipelines import run_load
    from stratus.session import shared_dir
    path = shared_dir(spark, "report")
    run_load(spark, S.unified_lines(spark, sf), shared_dir(spark, "table"), report_path=path)
    sample = lambda fields: f"array<struct<{fields}>>"
    schema = (f"import struct<total_lines: string, total_errors: string, error_types: map<string,string>, "
              f"errors_sample: {sample('row: string, type: string')}, parse_errors_sample: {sample('line: string, error: string')}>, "
              f"quality struct<total_documents: string, by_source: map<string,string>, date_range: map<string,string>>")
    doc = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    fact = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    of_map = lambda name: F.transform(F.map_entries(name), lambda e: fact(F.concat(F.lit(f"{name}."), e["key"]), e["value"]))
    of_list = lambda name, k, v: F.transform(name, lambda e: fact(F.concat(F.lit(f"{name}."), e[k]), e[v]))
    facts = F.concat(F.array(*(fact(F.lit(c), F.col(c)) for c in ("import.total_lines", "import.total_errors", "quality.total_documents"))),
                     of_map("import.error_types"), of_list("import.errors_sample", "row", "type"),
                     of_list("import.parse_errors_sample", "line", "error"), of_map("quality.by_source"),
                     F.filter(of_map("quality.date_range"), lambda f: f["key"] == "quality.date_range.min"))
    return doc.select(F.explode(facts).alias("f")).select("f.*")


# ===========================================================================
# K5, K6 on stored tables

@query("edit_table", f"""{OBS},
kept AS (SELECT {U23} FROM obs WHERE source <> 'manual'),
upd AS (SELECT {U23} FROM obs WHERE source = 'infoclimat' AND pos % 5 = 0
        QUALIFY row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY pos DESC) = 1),
merged AS (
  SELECT * FROM kept k WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.station_id IS NOT DISTINCT FROM k.station_id
    AND u."timestamp" IS NOT DISTINCT FROM k."timestamp")
  UNION ALL SELECT * REPLACE ('infoclimat' AS source, 'corrected' AS station_type) FROM upd)
SELECT * REPLACE (CASE WHEN station_id = '3' THEN 1.5 ELSE temperature_c END AS temperature_c) FROM merged""")
def q_edit_table(spark, sf):
    """A stored table after a delete (a whole partition goes), an upsert and an update."""
    from stratus.session import shared_dir
    from stratus.sinks.tables import delete_from_table, scan_table, update_table, upsert_table, write_layout
    path = shared_dir(spark, "edited")
    o = obs(spark, sf)
    write_layout(o, path)
    delete_from_table(spark, path, F.col("source") == "manual")
    updates = o.where((F.col("source") == "infoclimat") & (F.col("pos") % 5 == 0)).withColumn("station_type", F.lit("corrected"))
    upsert_table(spark, path, updates)
    update_table(spark, path, F.col("station_id") == "3", {"temperature_c": 1.5})
    return scan_table(spark, path).select(*UNIFIED_COLUMNS)
