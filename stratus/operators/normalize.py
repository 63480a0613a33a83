"""Unwrap, source detection, per-source projection, union.

Records are ``MAP<STRING,STRING>`` payloads (numbers kept as their JSON text,
nested values as JSON text), so a missing key and a JSON null both read as
null, and ``map_contains_key`` tells them apart where it matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratus.functions import (
    CONVERTERS, combine_date_time, combine_date_time_multi, compass_degrees,
    date_from_path, parse_measure, sheet_date, strip_blank, to_double, to_timestamp_coerce,
)
from stratus.functions.text import measure_token, token_to_double
from stratus.functions.time import clock_text, combine_date_clock
from stratus.sources.jsonl import last_values
from stratus.schema import (
    INFOCLIMAT_FIELDS, SOURCE_INFOCLIMAT, SOURCE_WU, UNIFIED_COLUMNS, UNIFIED_SCHEMA,
    WU_FIELDS, WU_RAIN_RATE_KEYS, WU_STATIONS,
)

UNKNOWN = "unknown"
WRAPPER_KEY = "_airbyte_data"  # FIXED VALUE: payload key of the ingestion wrapper


def unwrap(rec) -> Column:
    """The wrapped payload when the wrapper key is present, else the record.

    A wrapper whose value is not an object gives null; see
    :func:`payload_quarantine`.
    """
    rec = F.col(rec) if isinstance(rec, str) else rec
    inner = F.from_json(rec.getItem(WRAPPER_KEY), "map<string,string>")
    return F.when(F.map_contains_key(rec, F.lit(WRAPPER_KEY)), inner).otherwise(rec)


NO_PAYLOAD = "payload is not an object"


def with_payload(parsed: DataFrame) -> DataFrame:
    """Parsed lines with ``payload`` (P1; of a repeated key the last value counts),
    ``kind_code`` (P8, of the record by itself) and ``error``: why a line is unusable."""
    out = parsed.withColumn("_payload", unwrap("rec"))
    out = out.withColumn("payload", last_values(F.col("_payload"))).drop("_payload")
    error = F.coalesce(F.col("parse_error"), F.when(F.col("payload").isNull(), F.lit(NO_PAYLOAD)))
    return out.withColumn("kind_code", kind_code("payload")).withColumn("error", error)


def payload_quarantine(parsed: DataFrame, raw_chars: int | None = None) -> DataFrame:
    """Parsed records whose wrapped payload is null or not an object."""
    raw = F.col("value") if raw_chars is None else F.left("value", F.lit(raw_chars))
    return (parsed.filter(F.col("parse_error").isNull() & unwrap("rec").isNull())
            .select("file_path", "split_start", "row_id", F.lit(NO_PAYLOAD).alias("error"), raw.alias("raw")))


KINDS = [UNKNOWN, SOURCE_INFOCLIMAT, SOURCE_WU]


def kind_code(payload) -> Column:
    """P8 on one record, as an index into ``KINDS``: nested-source keys -> infoclimat; sheet keys -> WU."""
    p = F.col(payload) if isinstance(payload, str) else payload
    has = lambda k: F.map_contains_key(p, F.lit(k))
    code = lambda kind: F.lit(KINDS.index(kind))
    return (F.when(has("id_station") & has("dh_utc"), code(SOURCE_INFOCLIMAT))
            .when(has("Temperature") | has("Dew Point") | has("Time"), code(SOURCE_WU))
            .otherwise(code(UNKNOWN)))


def kind_name(code: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), code + 1)


def file_kinds(records: DataFrame) -> DataFrame:
    """The kind of each file's first record. Place in the split and kind are
    packed into one long (then, per file, with the split into one decimal), so
    that both minima are hash aggregates."""
    step = F.lit("1" + "0" * 19).cast("decimal(20,0)")  # beyond any long, and a multiple of 4
    splits = (records.groupBy("file_path", "rel_path", "split_start")
              .agg(F.min(F.col("row_id") * 4 + F.col("kind_code")).alias("first")))
    packed = (F.col("split_start").cast("decimal(17,0)") * step + F.col("first").cast("decimal(19,0)")).cast("decimal(38,0)")
    files = splits.groupBy("file_path", "rel_path").agg(F.min(packed).alias("first"))
    return files.select("file_path", "rel_path", kind_name((F.col("first") % 4).cast("int")).alias("kind"))


def detect_source(records: DataFrame, payload: str = "payload", per: str = "file",
                   file_attrs: dict[str, Column] | None = None) -> DataFrame:
    """Add ``kind``. ``per='file'``: every record of a file takes the kind
    of the file's first parsed record (H9); ``per='record'``: each its own.

    ``file_attrs`` are expressions over ``rel_path`` (station, path date...);
    in per-file mode they are evaluated once per file on the per-file table.
    That table has one row per file; AQE chooses its join from measured sizes.
    """
    attrs = file_attrs or {}
    kinds = records if "kind_code" in records.columns else records.withColumn("kind_code", kind_code(payload))
    if per == "record":
        out = kinds.withColumn("kind", kind_name(F.col("kind_code"))).drop("kind_code")
        for k, v in attrs.items():
            out = out.withColumn(k, v)
        return out
    first = file_kinds(kinds).select("file_path", "kind", *[v.alias(k) for k, v in attrs.items()])
    return kinds.drop("kind_code").join(first, "file_path", "left")


def infer_station(rel_path) -> Column:
    """P20: station id from the path below the input root."""
    p = F.col(rel_path) if isinstance(rel_path, str) else rel_path
    # FIXED VALUES: path markers and the station ids they map to
    # (case-insensitive name match without a per-row lower-casing pass).
    return (F.when(p.contains("BE") | p.rlike("(?iu)ichtegem"), F.lit("IICHTE19"))
            .when(p.contains("FR") | p.rlike("(?iu)madeleine"), F.lit("ILAMAD25"))
            .otherwise(F.lit("UNKNOWN")))


def _wu_meta(station: Column, field: str, unknown_default: Column | None) -> Column:
    pairs = []
    for sid, meta in WU_STATIONS.items():
        pairs += [F.lit(sid), F.lit(meta[field])]
    val = F.try_element_at(F.create_map(*pairs), station)
    if unknown_default is not None:
        known = F.try_element_at(F.create_map(*[x for sid in WU_STATIONS for x in (F.lit(sid), F.lit(True))]), station)
        val = F.when(known.isNotNull(), val).otherwise(unknown_default)
    return val


def infoclimat_columns(p: Column, station_id: Column | None = None,
                       meta: Column | None = None, staged=None) -> dict[str, Column]:
    """Nested-source record -> unified columns.

    Cloud form (``meta`` None): station name/coords null, type ``infoclimat_api``,
    station id from ``id_station`` (missing -> ``''``, null stays null). Local form: station id
    given, station fields from the ``meta`` struct (null when unknown).
    """
    raw = staged.raw if staged else p.getItem
    out: dict[str, Column] = {"source": F.lit(SOURCE_INFOCLIMAT)}
    if meta is None:
        present = F.col(staged.has_id) if staged else F.map_contains_key(p, F.lit("id_station"))
        out["station_id"] = F.when(present, raw("id_station")).otherwise(F.lit(""))
        out["station_name"] = F.lit(None).cast("string")
        out["latitude"] = F.lit(None).cast("double")
        out["longitude"] = F.lit(None).cast("double")
        out["elevation"] = F.lit(None).cast("double")
        out["station_type"] = F.lit("infoclimat_api")  # FIXED VALUE
    else:
        out["station_id"] = station_id
        out["station_name"] = meta.getItem("name")
        out["latitude"] = to_double(meta.getItem("latitude"))
        out["longitude"] = to_double(meta.getItem("longitude"))
        out["elevation"] = to_double(meta.getItem("elevation"))
        out["station_type"] = meta.getItem("type")
    for src, dst in INFOCLIMAT_FIELDS.items():
        v = raw(src)
        if dst == "timestamp":
            out[dst] = to_timestamp_coerce(v)
        elif dst == "weather_code":
            out[dst] = v  # not coerced
        else:
            out[dst] = token_to_double(staged.clean(src)) if staged else to_double(v)
    out["uv_index"] = F.lit(None).cast("double")
    out["solar_radiation_wm2"] = F.lit(None).cast("double")
    return out


def wu_columns(p: Column, station: Column, day: Column, variant: str = "cloud", staged=None) -> dict[str, Column]:
    """Sheet-source record -> unified columns (7 unit conversions).

    ``variant='cloud'``: 12-hour clock text + path date, unknown station ->
    ``Unknown_<id>``, UV parsed as a measure. ``variant='local'``: any time
    form + sheet date, UV plainly coerced, rain-rate key with trailing dot.
    """
    out: dict[str, Column] = {"source": F.lit(SOURCE_WU), "station_id": station}
    default_name = F.concat(F.lit("Unknown_"), station) if variant == "cloud" else None
    out["station_name"] = _wu_meta(station, "station_name", default_name)
    for f in ("latitude", "longitude", "elevation"):
        out[f] = _wu_meta(station, f, F.lit(None).cast("double") if variant == "cloud" else None)
    out["station_type"] = _wu_meta(station, "station_type",
                                   F.lit(SOURCE_WU) if variant == "cloud" else None)
    raw = staged.raw if staged else p.getItem
    measure = (lambda k: token_to_double(staged.token(k))) if staged else (lambda k: parse_measure(p.getItem(k)))
    if variant == "cloud":
        out["timestamp"] = combine_date_time(day, raw("Time"))
    elif staged:
        out["timestamp"] = combine_date_clock(day, staged.clock)
    else:
        out["timestamp"] = combine_date_time_multi(day, raw("Time"))
    for src, dst, conv in WU_FIELDS:
        v = measure(src)
        out[dst] = CONVERTERS[conv](v) if conv else v
    out["precip_rate_mm"] = CONVERTERS["in_to_mm"](measure(WU_RAIN_RATE_KEYS[variant]))
    out["wind_direction_deg"] = compass_degrees(raw("Wind"))
    out["uv_index"] = measure("UV") if variant == "cloud" else to_double(raw("UV"))
    for f in ("visibility_m", "cloud_cover_octas", "snow_depth_cm"):
        out[f] = F.lit(None).cast("double")
    out["weather_code"] = F.lit(None).cast("string")
    return out


def unified_select(cols: dict[str, Column]) -> list[Column]:
    """The 23 columns in their fixed order and types; a missing one is an error."""
    missing = [c for c in UNIFIED_COLUMNS if c not in cols]
    if missing:
        raise KeyError(f"missing unified columns: {missing}")
    return [cols[f.name].cast(f.dataType).alias(f.name) for f in UNIFIED_SCHEMA.fields]


def project_by_kind(records: DataFrame, payload: str = "payload", kind: str = "kind",
                    rel_path: str = "rel_path", date_order: str = "DMY",
                    keep: tuple[str, ...] = ("file_path", "split_start", "row_id", "weather_code_number")) -> DataFrame:
    """P2+P3 in one pass: each row is projected by its kind; unknown kinds
    dropped. Uses per-file ``file_station`` / ``file_date`` when present."""
    p = F.col(payload)
    cols = records.columns
    keep = tuple(c for c in keep if c in cols)
    station = F.col("file_station") if "file_station" in cols else infer_station(F.col(rel_path))
    day = F.col("file_date") if "file_date" in cols else date_from_path(F.col(rel_path), date_order)
    recs = records.filter(F.col(kind).isin(SOURCE_INFOCLIMAT, SOURCE_WU))
    staged_df, st = stage_fields(recs.select(*keep, F.col(kind).alias("_kind"), station.alias("_station"),
                                             day.alias("_day"), p.alias("_payload"),
                                             F.map_contains_key(p, F.lit("id_station")).alias("_has_id")), "_payload",
                                 raw_keys=["id_station", "Time", "Wind"] + list(INFOCLIMAT_FIELDS),
                                 clean_keys=[k for k, v in INFOCLIMAT_FIELDS.items()
                                             if v not in ("timestamp", "weather_code")],
                                 token_keys=[f[0] for f in WU_FIELDS] + [WU_RAIN_RATE_KEYS["cloud"], "UV"])
    ic = infoclimat_columns(p, staged=st)
    wu = wu_columns(p, F.col("_station"), F.col("_day"), "cloud", staged=st)
    is_ic = F.col("_kind") == F.lit(SOURCE_INFOCLIMAT)
    merged = {c: F.when(is_ic, ic[c]).otherwise(wu[c]) for c in UNIFIED_COLUMNS}
    return staged_df.select(*keep, *unified_select(merged))


class _Staged:
    has_id = "_has_id"
    clock = "_clock"

    def __init__(self, raw, clean, token):
        self._raw, self._clean, self._token = raw, clean, token

    def raw(self, k: str) -> Column:
        return F.col(self._raw[k])

    def clean(self, k: str) -> Column:
        return F.col(self._clean[k])

    def token(self, k: str) -> Column:
        return F.col(self._token[k])


def stage_fields(df: DataFrame, payload: str, raw_keys: list[str], clean_keys: list[str],
                 token_keys: list[str]) -> tuple[DataFrame, _Staged]:
    """Extract each payload key once, then its cleaned text / numeric token
    once, as real columns: the final projection refers to them instead of
    repeating map lookups and string clean-up inside every CASE branch."""
    keys = list(dict.fromkeys(raw_keys + clean_keys + token_keys))
    raw = {k: f"_raw{i}" for i, k in enumerate(keys)}
    p = F.col(payload)
    s1 = df.select("*", *[p.getItem(k).alias(raw[k]) for k in keys]).drop(payload)
    clean = {k: f"_cln{i}" for i, k in enumerate(clean_keys)}
    token = {k: f"_tok{i}" for i, k in enumerate(token_keys)}
    s2 = s1.select("*", *[strip_blank(F.col(raw[k])).alias(clean[k]) for k in clean_keys],
                   *[measure_token(F.col(raw[k])).alias(token[k]) for k in token_keys])
    return s2, _Staged(raw, clean, token)


#: FIXED VALUES: columns that a sheet of the local variant must have beside ``Time``.
SHEET_COLUMNS = ["Temperature", "Dew Point", "Humidity", "Wind", "Speed", "Gust", "Pressure", "Precip. Rate.", "Precip. Accum."]


def missing_sheet_columns(records: DataFrame, payload: str = "payload") -> DataFrame:
    """P5 on the input: per sheet file with a ``Time`` column, the required columns
    that no row of it has (``missing``, in their order; empty where none is missing).
    One aggregate of one flag per column."""
    p = F.col(payload)
    held = records.groupBy("file_path").agg(
        F.bool_or(F.map_contains_key(p, F.lit("Time"))).alias("_time"),
        *(F.bool_or(F.map_contains_key(p, F.lit(c))).alias(f"_{i}") for i, c in enumerate(SHEET_COLUMNS)))
    missing = F.array_compact(F.array(*(F.when(~F.col(f"_{i}"), F.lit(c)) for i, c in enumerate(SHEET_COLUMNS))))
    return held.filter("_time").select("file_path", missing.alias("missing"))


def require_sheet_columns(records: DataFrame, payload: str = "payload") -> None:
    """P5: raise when a sheet lacks a column, naming the first such sheet."""
    bad = missing_sheet_columns(records, payload).filter(F.size("missing") > 0).orderBy("file_path").limit(1).collect()
    if bad:
        raise KeyError(f"missing columns in {bad[0].file_path}: {list(bad[0].missing)}")


def sheet_rows(records: DataFrame, station_of_file: Column, payload: str = "payload",
               sheet_name: Column | None = None) -> DataFrame:
    """S5 + P3 (local): sheet files (one file = one day) -> unified rows.

    A sheet is skipped when its name has no valid DDMMYY date, when every row
    is blank, or when no row has a ``Time`` field. Rows whose values are all
    null are dropped first (P7).
    """
    p = F.col(payload)
    if sheet_name is None:
        sheet_name = F.regexp_extract(F.col("file_path"), r"([^/]*?)(\.[^./]*)?$", 1)
    nonnull = F.exists(F.map_values(p), lambda v: v.isNotNull())
    rows = records.filter(nonnull)
    sheets = (rows.groupBy("file_path")
              .agg(F.max(F.map_contains_key(p, F.lit("Time")).cast("int")).alias("_has_time")))
    # name, day and station are read once per file: a condition on the path alone would be moved to the rows
    sheets = sheets.withColumn("_day", F.when(F.col("_has_time") == 1, sheet_date(sheet_name)))
    sheets = sheets.filter(F.col("_day").isNotNull()).withColumn("_station", station_of_file)
    known = F.col("_station").isin(*WU_STATIONS.keys())
    station = F.when(known, F.col("_station")).otherwise(
        F.raise_error(F.concat(F.lit("unknown sheet station: "), F.col("_station"))))
    rows = rows.join(sheets.select("file_path", "_day", station.alias("_station")), "file_path")
    keep = ("file_path", "split_start", "row_id")
    staged_df, st = stage_fields(rows.select(*keep, "_day", "_station", clock_text(p.getItem("Time")).alias("_clock"), p.alias("_payload")), "_payload",
                                 raw_keys=["Wind", "UV"], clean_keys=[],
                                 token_keys=[f[0] for f in WU_FIELDS] + [WU_RAIN_RATE_KEYS["local"]])
    cols = wu_columns(p, F.col("_station"), F.col("_day"), "local", staged=st)
    return staged_df.select(*keep, *unified_select(cols))


def drop_all_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows whose every (subset) column is null."""
    cols = subset or df.columns
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(f"`{c}`").isNotNull()
    return df.filter(cond)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union all by column name, missing columns as null, ``_part`` keeps
    the input order of the frames."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("_part", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
