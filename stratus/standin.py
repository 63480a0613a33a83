"""Stand-in inputs built from the driver's test tables.

The reference's raw inputs are not available, so each job's input is derived
from ``events`` (and ``supplier``/``nation`` for the station dimension). The
builders only shape rows into the schema a job expects: typed observations,
raw JSON-lines with file paths, unified JSON-lines, nested documents, sheet
files. They do none of the job's work (no parsing, conversion, dedup or
validation); that runs through the library on whatever these rows contain.

Odd values (nulls, bad text, out-of-range numbers, malformed lines) are
placed by fixed ``event_id`` rules so that an independent SQL statement can
state the expected result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

COMPASS_TEXTS = ["North", "NNE", "NE", "ENE", "East", "ESE", "SE", "SSE",
                 "South", "SSW", "SW", "WSW", "West", "WNW", "NW", "NNW", "Calm", "Variable"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Generated inputs are written once per session and sf to the shared folder
# and read back: a job then starts from a parallel scan of stored rows, as it
# would from landed files (and filters are not pushed into the generator).
_WRITTEN: dict[tuple, str] = {}


def materialized(builder):
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        from stratus.session import shared_dir
        key = (spark.sparkContext.applicationId, sf_dir, builder.__name__)
        path = _WRITTEN.get(key)
        if path is None:
            path = shared_dir(spark, f"standin-{builder.__name__}")
            # several files, as landed inputs are; no shuffle
            builder(spark, sf_dir).write.option("maxRecordsPerFile", 20_000).mode("overwrite").parquet(path)
            _WRITTEN[key] = path
        return spark.read.parquet(path)
    wrapper.__name__ = builder.__name__
    wrapper.__doc__ = builder.__doc__
    return wrapper


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write every generated input for ``sf_dir`` ahead of time."""
    for b in (raw_lines, unified_lines, documents, sheet_lines):
        b(spark, sf_dir)


# ---------------------------------------------------------------------------
# Typed observations (23 unified columns + pos). Each entry is SQL text valid
# in both Spark SQL and DuckDB; only the timestamp differs by dialect.
OBS_EXPRS = [
    ("pos", "event_id"),
    ("source", "CASE WHEN event_id % 101 = 17 THEN 'manual' "
               "WHEN event_type IN ('purchase', 'error') THEN 'infoclimat' ELSE 'weather_underground' END"),
    ("station_id", "CASE WHEN event_id % 211 = 3 THEN NULL ELSE CAST(user_id AS STRING) END"),
    ("station_name", "CASE WHEN event_id % 157 = 9 THEN NULL ELSE 'Station ' || CAST(user_id AS STRING) END"),
    ("latitude", "CASE WHEN event_id % 193 = 11 THEN 95.5 ELSE 42.0 + CAST(user_id % 90 AS DOUBLE) / 10 END"),
    ("longitude", "-4.0 + CAST(user_id % 80 AS DOUBLE) / 8"),
    ("elevation", "CAST(user_id % 400 AS DOUBLE)"),
    ("station_type", "event_type"),
    ("timestamp", None),
    ("temperature_c", "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 89 = 5 THEN 61.5 "
                      "ELSE value / 8 - 15 END"),
    ("dew_point_c", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 10 - 20 END"),
    ("humidity_pct", "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 97 = 1 THEN 100.01 "
                     "ELSE CAST(event_id % 101 AS DOUBLE) END"),
    ("wind_direction_deg", "CASE WHEN event_id % 56 = 0 THEN NULL ELSE CAST(event_id % 16 AS DOUBLE) * 22.5 END"),
    ("wind_speed_kmh", "value / 7"),
    ("wind_gust_kmh", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 5 END"),
    ("pressure_hpa", "CASE WHEN event_id % 83 = 2 THEN 869.99 ELSE 980.0 + CAST(event_id % 60 AS DOUBLE) END"),
    ("precip_rate_mm", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 7 AS DOUBLE) / 4 END"),
    ("precip_accum_mm", "CASE WHEN event_id % 5 = 1 THEN NULL ELSE CAST(event_id % 9 AS DOUBLE) / 2 END"),
    ("visibility_m", "CASE WHEN event_id % 80 = 0 THEN CAST(event_id % 10000 AS DOUBLE) ELSE NULL END"),
    ("cloud_cover_octas", "CASE WHEN event_id % 200 = 0 THEN CAST(event_id % 9 AS DOUBLE) ELSE NULL END"),
    ("snow_depth_cm", "CAST(NULL AS DOUBLE)"),
    ("weather_code", "CASE WHEN event_id % 500 = 0 THEN CAST(event_id % 100 AS STRING) ELSE NULL END"),
    ("uv_index", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 11 AS DOUBLE) END"),
    ("solar_radiation_wm2", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 900 AS DOUBLE) END"),
]
OBS_TS_SPARK = "CASE WHEN event_id % 199 = 13 THEN NULL ELSE CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) END"
OBS_TS_DUCK = "CASE WHEN event_id % 199 = 13 THEN NULL ELSE date_trunc('hour', ts) END"


def obs_select_sql(dialect: str) -> str:
    parts = []
    for name, expr in OBS_EXPRS:
        if expr is None:
            expr = OBS_TS_SPARK if dialect == "spark" else OBS_TS_DUCK
        parts.append(f"{expr} AS `{name}`" if dialect == "spark" else f'{expr} AS "{name}"')
    return ",\n  ".join(parts)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed unified observations, one per event (pos = event_id)."""
    exprs = [f"{(OBS_TS_SPARK if e is None else e)} AS `{n}`" for n, e in OBS_EXPRS]
    return table(spark, sf_dir, "events").selectExpr(*exprs)


# Non-finite values for the sanitize operator (same text in both dialects).
NONFINITE_EXPRS = {
    "temperature_c": "CASE WHEN event_id % 37 = 0 THEN CAST('NaN' AS DOUBLE) "
                     "WHEN event_id % 41 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value / 8 - 15 END",
    "wind_speed_kmh": "CASE WHEN event_id % 43 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value / 7 END",
}


def observations_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    base = [f"{(OBS_TS_SPARK if e is None else NONFINITE_EXPRS.get(n, e))} AS `{n}`" for n, e in OBS_EXPRS]
    return ev.selectExpr(*base)


# ---------------------------------------------------------------------------
# Raw wrapped JSON-lines (cloud transform input):
#   view/click/signup -> sheet-source lines, /raw/<BE|FR|NL>/<ddMMyy>/<type>.jsonl
#   purchase          -> nested-source lines, /raw/infoclimat/<ddMMyy>/hourly.jsonl
#   error             -> lines of an unknown kind, /raw/misc/<ddMMyy>/log.json
# event_id % 151 = 0 -> blank line; % 149 = 0 -> truncated JSON;
# % 7 = 3 -> payload without the wrapper.

@materialized
def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, ts, value = F.col("event_id"), F.col("ts"), F.col("value")
    nb = F.lit("\u00a0")
    day = F.date_format(ts, "ddMMyy")
    country = (F.when(F.col("user_id") % 3 == 0, "BE").when(F.col("user_id") % 3 == 1, "FR").otherwise("NL"))
    kind = (F.when(F.col("event_type").isin("view", "click", "signup"), "wu")
            .when(F.col("event_type") == "purchase", "ic").otherwise("misc"))
    s = lambda c: c.cast("string")
    wu = F.to_json(F.struct(
        F.concat(F.date_format(ts, "h:mm"), F.when(eid % 5 == 2, nb).otherwise(F.lit(" ")),
                 F.date_format(ts, "a")).alias("Time"),
        F.concat(F.printf(F.lit("%.2f"), value), nb, F.lit("°F")).alias("Temperature"),
        F.concat(F.printf(F.lit("%.2f"), value - 10), nb, F.lit("°F")).alias("Dew Point"),
        F.concat(s(eid % 101), nb, F.lit("%")).alias("Humidity"),
        F.element_at(F.array(*[F.lit(t) for t in COMPASS_TEXTS]), (eid % 18 + 1).cast("int")).alias("Wind"),
        F.concat(s(eid % 40), F.lit("."), s(eid % 10), nb, F.lit("mph")).alias("Speed"),
        F.when(eid % 4 != 0, F.concat(s(eid % 60), F.lit(".5"), nb, F.lit("mph"))).alias("Gust"),
        F.concat(s(28 + eid % 3), F.lit("."), F.lpad(s(eid % 100), 2, "0"), nb, F.lit("in")).alias("Pressure"),
        F.when(eid % 6 == 0, F.lit("--"))
         .otherwise(F.concat(F.lit("0.0"), s(eid % 10), nb, F.lit("in"))).alias("Precip. Rate"),
        F.concat(F.lit("0."), F.lpad(s(eid % 50), 2, "0"), nb, F.lit("in")).alias("Precip. Accum."),
        s(eid % 11).alias("UV"),
        F.concat(s(eid % 900), nb, F.lit("w/m²")).alias("Solar"),
    ), {"ignoreNullFields": "false"})
    ic = F.to_json(F.struct(
        s(F.col("user_id")).alias("id_station"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("dh_utc"),
        (value / 8 - 15).alias("temperature"),
        (value / 10 - 20).alias("point_de_rosee"),
        (eid % 100).alias("humidite"),
        ((eid % 36) * 10).alias("vent_direction"),
        (value / 7).alias("vent_moyen"),
        F.when(eid % 5 != 0, value / 5).alias("vent_rafales"),
        (980 + eid % 60).alias("pression"),
        F.when(eid % 6 != 0, s(eid % 7)).alias("pluie_1h"),
        F.when(eid % 9 == 0, F.lit("n/a")).otherwise(s(eid % 9)).alias("pluie_3h"),
        F.when(eid % 80 == 0, eid % 10000).alias("visibilite"),
        F.when(eid % 200 == 0, eid % 9).alias("nebulosite"),
        F.lit(None).cast("double").alias("neige_au_sol"),
        F.when(eid % 50 == 0, s(eid % 100)).alias("temps_omm"),
    ), {"ignoreNullFields": "false"})
    misc = F.to_json(F.struct(F.lit("error").alias("level"), F.col("props").alias("message")))
    payload = F.when(kind == "wu", wu).when(kind == "ic", ic).otherwise(misc)
    wrapped = F.when(eid % 7 == 3, payload).otherwise(F.concat(F.lit('{"_airbyte_data": '), payload, F.lit("}")))
    line = (F.when(eid % 151 == 0, F.lit("   "))
            .when(eid % 149 == 0, F.concat(F.lit('{"_airbyte_data": {"Time": "'), F.date_format(ts, "h:mm")))
            .otherwise(wrapped))
    path = (F.when(kind == "wu", F.concat(F.lit("/raw/"), country, F.lit("/"), day, F.lit("/"),
                                          F.col("event_type"), F.lit(".jsonl")))
            .when(kind == "ic", F.concat(F.lit("/raw/infoclimat/"), day, F.lit("/hourly.jsonl")))
            .otherwise(F.concat(F.lit("/raw/misc/"), day, F.lit("/log.json"))))
    return ev.select(path.alias("file_path"), F.lit(0).cast("long").alias("split_start"),
                     eid.alias("row_id"), line.alias("value"), path.alias("rel_path"))


# ---------------------------------------------------------------------------
# Unified JSON-lines (load input), from the typed observations:
#   timestamp text: % 41 = 4 -> 'Z' suffix; % 43 = 5 -> '+02:00'; % 47 = 6 -> unparseable
#   % 61 = 2 -> numeric weather_code; % 3 = 0 -> solar radiation as an integer
#   station_name null and event_id even -> key absent
#   % 293 = 0 -> truncated line; % 307 = 0 -> blank line

@materialized
def unified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    eid = F.col("pos")
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    ts_text = (F.when(F.col("timestamp").isNull(), F.lit(None))
               .when(eid % 41 == 4, F.concat(iso, F.lit("Z")))
               .when(eid % 43 == 5, F.concat(iso, F.lit("+02:00")))
               .when(eid % 47 == 6, F.lit("not-a-date"))
               .otherwise(iso))
    cols = [ts_text.alias("timestamp") if c == "timestamp" else F.col(c) for c in obs.columns if c != "pos"]
    js = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    js = F.when(eid % 61 == 2, F.regexp_replace(js, '"weather_code":null', '"weather_code":7')).otherwise(js)
    js = F.when(eid % 3 == 0, F.regexp_replace(js, r'"solar_radiation_wm2":(\d+)\.0\}', '"solar_radiation_wm2":$1}')
                ).otherwise(js)
    js = F.when(eid % 2 == 0, F.regexp_replace(js, '"station_name":null,', "")).otherwise(js)
    line = (F.when(eid % 307 == 0, F.lit(""))
            .when(eid % 293 == 0, F.lit('{"source": "infoclimat", "station_id": '))
            .otherwise(js))
    return obs.select(F.lit("/load/weather_data.jsonl").alias("file_path"),
                      F.lit(0).cast("long").alias("split_start"), eid.alias("row_id"), line.alias("value"))


# ---------------------------------------------------------------------------
# Nested documents (local transform input): one document per (user, day) of
# events, /docs/<user>_<yyyyMMdd>.json, with
#   stations: the user's station twice (first with a stale name; last wins),
#             omitted when user_id % 5 = 4 (unknown station)
#   hourly:   {"<user>": [records...], "_params": {...}}
# Records with event_id % 29 = 0 carry an unparseable dh_utc, % 31 = 0 an
# unparseable temperature.

@materialized
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, value = F.col("event_id"), F.col("value")
    rec = F.struct(
        eid.alias("event_id"),
        F.when(eid % 29 == 0, F.lit("yesterday"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("dh_utc"),
        F.when(eid % 31 == 0, F.lit("n/a")).otherwise((value / 8 - 15).cast("string")).alias("temperature"),
        (value / 10 - 20).alias("point_de_rosee"),
        (eid % 100).alias("humidite"),
        ((eid % 36) * 10).alias("vent_direction"),
        (value / 7).alias("vent_moyen"),
        (980 + eid % 60).alias("pression"),
        F.when(eid % 50 == 0, (eid % 100).cast("string")).alias("temps_omm"),
    )
    uid = F.col("user_id").cast("string")
    grouped = (ev.groupBy("user_id", F.to_date("ts").alias("day"))
               .agg(F.array_sort(F.collect_list(rec)).alias("recs")))
    station = lambda name: F.struct(uid.alias("id"), name.alias("name"),
                                    (42.0 + (F.col("user_id") % 90) / 10).alias("latitude"),
                                    (-4.0 + (F.col("user_id") % 80) / 8).alias("longitude"),
                                    (F.col("user_id") % 400).alias("elevation"),
                                    F.lit("synop").alias("type"))
    stations = F.when(F.col("user_id") % 5 == 4, F.array().cast("array<struct<id:string,name:string,"
                                                                    "latitude:double,longitude:double,"
                                                                    "elevation:bigint,type:string>>")) \
        .otherwise(F.array(station(F.concat(F.lit("Old "), uid)), station(F.concat(F.lit("Station "), uid))))
    hourly = F.create_map(uid, F.to_json("recs"), F.lit("_params"), F.lit('{"unit": "metric"}'))
    # hourly values must be JSON, not quoted text: splice them in as raw JSON.
    doc = F.concat(F.lit('{"stations": '), F.to_json(stations), F.lit(', "hourly": {"'), uid,
                   F.lit('": '), F.to_json("recs"), F.lit(', "_params": {"unit": "metric"}}}'))
    path = F.concat(F.lit("/docs/"), uid, F.lit("_"), F.date_format("day", "yyyyMMdd"), F.lit(".json"))
    return grouped.select(path.alias("file_path"), doc.alias("value"))


# Sheet files (local transform input): all events, one file per (station
# workbook, day):
# /sheets/<IICHTE19|ILAMAD25>/<ddMMyy>.jsonl. Event id % 23 = 0 -> an
# all-null row; clock text rotates through 12-hour, 24-hour and full forms.

@materialized
def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, ts, value = F.col("event_id"), F.col("ts"), F.col("value")
    nb = F.lit("\u00a0")
    s = lambda c: c.cast("string")
    station = F.when(F.col("user_id") % 4 == 0, "IICHTE19").otherwise("ILAMAD25")
    time_text = (F.when(eid % 3 == 0, F.date_format(ts, "h:mm a"))
                 .when(eid % 3 == 1, F.date_format(ts, "HH:mm:ss"))
                 .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    row = F.to_json(F.struct(
        time_text.alias("Time"),
        F.concat(F.printf(F.lit("%.2f"), value), nb, F.lit("°F")).alias("Temperature"),
        F.concat(s(eid % 101), nb, F.lit("%")).alias("Humidity"),
        F.element_at(F.array(*[F.lit(t) for t in COMPASS_TEXTS]), (eid % 18 + 1).cast("int")).alias("Wind"),
        F.concat(s(eid % 40), F.lit("."), s(eid % 10), nb, F.lit("mph")).alias("Speed"),
        F.concat(s(28 + eid % 3), F.lit("."), F.lpad(s(eid % 100), 2, "0"), nb, F.lit("in")).alias("Pressure"),
        F.concat(F.lit("0.0"), s(eid % 10), nb, F.lit("in")).alias("Precip. Rate."),
        s(eid % 11).alias("UV"),
    ))
    empty = F.lit('{"Time": null, "Temperature": null, "Humidity": null}')
    line = F.when(eid % 23 == 0, empty).otherwise(row)
    path = F.concat(F.lit("/sheets/"), station, F.lit("/"), F.date_format(ts, "ddMMyy"), F.lit(".jsonl"))
    return ev.select(path.alias("file_path"), F.lit(0).cast("long").alias("split_start"),
                     eid.alias("row_id"), line.alias("value"), path.alias("rel_path"))


# ---------------------------------------------------------------------------
# Station dimension: suppliers, then nations (a nation key that equals a
# supplier key is a later entry of the same station id: last wins).

def stations_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("station_id"), F.col("s_name").alias("station_name"),
        (F.col("s_nationkey") * 2.0).alias("latitude"), (F.col("s_acctbal") / 1000).alias("longitude"),
        F.lit(10.0).alias("elevation"), F.lit("synop").alias("station_type"),
        F.col("s_suppkey").alias("pos"))
    nat = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("station_id"), F.col("n_name").alias("station_name"),
        (F.col("n_regionkey") * 10.0).alias("latitude"), F.lit(5.0).alias("longitude"),
        F.lit(20.0).alias("elevation"), F.lit("manual").alias("station_type"),
        (F.col("n_nationkey") + F.lit(10_000_000)).alias("pos"))
    return sup.unionByName(nat)


def obs_for_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations without station fields (to be enriched by the dimension)."""
    return observations(spark, sf_dir).drop("station_name", "latitude", "longitude", "elevation", "station_type")
