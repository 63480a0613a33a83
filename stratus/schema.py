"""Unified observation schema, rule sets and static dimensions.

The lists and maps marked FIXED VALUES must equal the reference's for results
to match (column names and order, unit map, station metadata, rule limits).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: unified column order (23 columns).
UNIFIED_COLUMNS = [
    "source", "station_id", "station_name",
    "latitude", "longitude", "elevation", "station_type",
    "timestamp",
    "temperature_c", "dew_point_c", "humidity_pct",
    "wind_direction_deg", "wind_speed_kmh", "wind_gust_kmh",
    "pressure_hpa", "precip_rate_mm", "precip_accum_mm",
    "visibility_m", "cloud_cover_octas", "snow_depth_cm", "weather_code",
    "uv_index", "solar_radiation_wm2",
]

STRING_COLUMNS = {"source", "station_id", "station_name", "station_type", "weather_code"}
TIMESTAMP_COLUMNS = {"timestamp"}


def _spark_type(name: str) -> T.DataType:
    if name in STRING_COLUMNS:
        return T.StringType()
    if name in TIMESTAMP_COLUMNS:
        return T.TimestampNTZType()
    return T.DoubleType()


UNIFIED_SCHEMA = T.StructType([T.StructField(c, _spark_type(c), True) for c in UNIFIED_COLUMNS])

KEY_COLUMNS = ["station_id", "timestamp"]

# FIXED VALUES: post-load measure fields (null-rate report), in this order.
MEASURE_COLUMNS = [
    "temperature_c", "dew_point_c", "humidity_pct", "wind_direction_deg",
    "wind_speed_kmh", "wind_gust_kmh", "pressure_hpa", "precip_rate_mm",
    "precip_accum_mm", "visibility_m", "cloud_cover_octas", "snow_depth_cm",
    "weather_code", "uv_index", "solar_radiation_wm2",
]

# FIXED VALUES: columns numerically coerced when the nested source is parsed.
COERCED_NUMERIC = [
    "latitude", "longitude", "elevation", "temperature_c", "dew_point_c",
    "humidity_pct", "wind_direction_deg", "wind_speed_kmh", "wind_gust_kmh",
    "pressure_hpa", "precip_rate_mm", "precip_accum_mm", "visibility_m",
    "snow_depth_cm", "cloud_cover_octas",
]

# FIXED VALUES: integer -> double widening on load (strict and core loaders).
WIDEN_STRICT = [
    "latitude", "longitude", "elevation", "temperature_c", "dew_point_c",
    "humidity_pct", "wind_direction_deg", "wind_speed_kmh", "wind_gust_kmh",
    "pressure_hpa", "precip_rate_mm", "precip_accum_mm", "visibility_m",
    "snow_depth_cm", "solar_radiation_wm2",
]
WIDEN_CORE = [
    "latitude", "longitude", "elevation", "temperature_c", "dew_point_c",
    "humidity_pct", "wind_direction_deg", "wind_speed_kmh", "wind_gust_kmh",
    "pressure_hpa", "precip_rate_mm", "precip_accum_mm",
]

# FIXED VALUES: compass text -> degrees (16 entries; trimmed, case-sensitive).
COMPASS_DEGREES = {
    "North": 0.0, "NNE": 22.5, "NE": 45.0, "ENE": 67.5,
    "East": 90.0, "ESE": 112.5, "SE": 135.0, "SSE": 157.5,
    "South": 180.0, "SSW": 202.5, "SW": 225.0, "WSW": 247.5,
    "West": 270.0, "WNW": 292.5, "NW": 315.0, "NNW": 337.5,
}

# FIXED VALUES: the two sheet-source stations.
WU_STATIONS = {
    "IICHTE19": {"station_name": "WeerstationBS", "latitude": 51.092, "longitude": 2.999,
                 "elevation": 15.0, "station_type": "weather_underground"},
    "ILAMAD25": {"station_name": "La Madeleine", "latitude": 50.659, "longitude": 3.07,
                 "elevation": 23.0, "station_type": "weather_underground"},
}

# FIXED VALUES: source names.
SOURCE_INFOCLIMAT = "infoclimat"
SOURCE_WU = "weather_underground"
SOURCES = [SOURCE_INFOCLIMAT, SOURCE_WU]

# FIXED VALUES: nested-source field -> unified column (hourly record keys).
INFOCLIMAT_FIELDS = {
    "dh_utc": "timestamp",
    "temperature": "temperature_c",
    "point_de_rosee": "dew_point_c",
    "humidite": "humidity_pct",
    "vent_direction": "wind_direction_deg",
    "vent_moyen": "wind_speed_kmh",
    "vent_rafales": "wind_gust_kmh",
    "pression": "pressure_hpa",
    "pluie_1h": "precip_rate_mm",
    "pluie_3h": "precip_accum_mm",
    "visibilite": "visibility_m",
    "nebulosite": "cloud_cover_octas",
    "neige_au_sol": "snow_depth_cm",
    "temps_omm": "weather_code",
}

# FIXED VALUES: sheet-source field -> (unified column, unit conversion).
# Rain-rate key differs by variant: "Precip. Rate." (local) / "Precip. Rate" (cloud).
WU_FIELDS = [
    ("Temperature", "temperature_c", "f_to_c"),
    ("Dew Point", "dew_point_c", "f_to_c"),
    ("Humidity", "humidity_pct", None),
    ("Speed", "wind_speed_kmh", "mph_to_kmh"),
    ("Gust", "wind_gust_kmh", "mph_to_kmh"),
    ("Pressure", "pressure_hpa", "inhg_to_hpa"),
    ("Precip. Accum.", "precip_accum_mm", "in_to_mm"),
    ("Solar", "solar_radiation_wm2", None),
]
WU_RAIN_RATE_KEYS = {"local": "Precip. Rate.", "cloud": "Precip. Rate"}

# ---------------------------------------------------------------------------
# Validation rule sets. Each property: allowed JSON/BSON types, optional
# inclusive minimum / maximum, optional enum. FIXED VALUES (limits and types).
_MEASURE_RULES = {
    "temperature_c": (("double", "null"), -60, 60),
    "dew_point_c": (("double", "null"), None, None),
    "humidity_pct": (("double", "null"), 0, 100),
    "wind_direction_deg": (("double", "null"), 0, 360),
    "wind_speed_kmh": (("double", "null"), 0, None),
    "wind_gust_kmh": (("double", "null"), 0, None),
    "pressure_hpa": (("double", "null"), 870, 1084),
    "precip_rate_mm": (("double", "null"), 0, None),
    "precip_accum_mm": (("double", "null"), 0, None),
    "visibility_m": (("double", "null"), 0, None),
    "cloud_cover_octas": (("double", "int", "null"), 0, 8),
    "snow_depth_cm": (("double", "null"), 0, None),
    "weather_code": (("string", "null"), None, None),
    "uv_index": (("double", "int", "null"), 0, None),
    "solar_radiation_wm2": (("double", "null"), 0, None),
}

RULESETS = {
    # local loader: six required fields, station fields typed
    "strict": {
        "required": ["source", "station_id", "station_name", "latitude", "longitude", "timestamp"],
        "properties": {
            "source": (("string",), None, None),
            "station_id": (("string",), None, None),
            "station_name": (("string",), None, None),
            "latitude": (("double",), -90, 90),
            "longitude": (("double",), -180, 180),
            "elevation": (("double", "int", "null"), None, None),
            "station_type": (("string", "null"), None, None),
            "timestamp": (("date",), None, None),
            **_MEASURE_RULES,
        },
        "enum": {"source": SOURCES},
        "widen": WIDEN_STRICT,
    },
    # cloud loader: three required fields, no station-field rules
    "core": {
        "required": ["source", "station_id", "timestamp"],
        "properties": {
            "source": (("string",), None, None),
            "station_id": (("string",), None, None),
            "timestamp": (("date",), None, None),
            **_MEASURE_RULES,
        },
        "enum": {"source": SOURCES},
        "widen": WIDEN_CORE,
    },
}
