"""Quality metrics and reports.

Reports come in long form, one row per fact:
``(section STRING, key STRING, num DOUBLE, txt STRING)``; see
:func:`report_lines` for JSON text. All per-column metrics
of a report are computed in one partial+final aggregation grouped by
(source, station_id), which is then rolled up; the duplicate count is a
second aggregation that reads only the key columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratus.operators.dedup import duplicates_all, duplicates_extra
from stratus.schema import KEY_COLUMNS, MEASURE_COLUMNS, UNIFIED_COLUMNS

REPORT_SCHEMA = "section string, key string, num double, txt string"


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN for floating columns (pandas ``isna``)."""
    col = F.col(f"`{c}`")
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _finite_or_null(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def ts_text(c: Column) -> Column:
    """Timestamp as ``YYYY-MM-DD HH:MM:SS[.ffffff]``."""
    base = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))


def num_text(c: Column) -> Column:
    return c.cast("string")


def _fact(section: str, key, num=None, txt=None) -> Column:
    k = F.lit(key) if isinstance(key, str) or key is None else key
    n = F.lit(None) if num is None else num
    t = F.lit(None) if txt is None else txt
    return F.struct(F.lit(section).alias("section"), k.cast("string").alias("key"),
                    n.cast("double").alias("num"), t.cast("string").alias("txt"))


def _pct(count: Column, total: Column) -> Column:
    """count / total * 100 in double precision, 2 dp; 0.0 when total is 0."""
    return F.coalesce(F.round(F.try_divide(count.cast("double"), total) * 100, 2), F.lit(0.0))


# ---------------------------------------------------------------------------
# single metrics

def count_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def count_by(df: DataFrame, col: str) -> DataFrame:
    """A2/A3: frequency table (nulls kept as their own group)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("records"))


def time_span(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.agg(F.min(col).alias("ts_min"), F.max(col).alias("ts_max"))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count_if(is_missing(df, c)).alias(c) for c in cols])


def null_rates(df: DataFrame, cols: list[str] = UNIFIED_COLUMNS) -> DataFrame:
    """A5: % missing per column, 2 dp, 0.0 on an empty table; long form."""
    agg = null_counts(df, cols)
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (agg.selectExpr("_total", f"stack({len(cols)}, {pairs}) as (column_name, nulls)")
            .select("column_name", _pct(F.col("nulls"), F.col("_total")).alias("null_rate_pct")))


def high_null_columns(df: DataFrame, cols: list[str] = UNIFIED_COLUMNS, threshold: float = 50.0) -> DataFrame:
    """Columns whose null rate exceeds ``threshold`` percent."""
    return null_rates(df, cols).filter(F.col("null_rate_pct") > threshold)


def key_null_counts(df: DataFrame) -> DataFrame:
    """Null timestamps and null station ids."""
    return df.agg(F.count_if(is_missing(df, "timestamp")).alias("invalid_timestamp"),
                  F.count_if(is_missing(df, "station_id")).alias("missing_station_id"))


def distinct_stations(df: DataFrame) -> DataFrame:
    """Distinct non-null station ids."""
    return df.agg(F.countDistinct("station_id").alias("stations"))


def missing_required(df: DataFrame, fields: list[str]) -> DataFrame:
    """A10: missing (null or absent) count per required field, non-zero only."""
    present = [c for c in fields if c in df.columns]
    exprs = [F.count_if(is_missing(df, c)).alias(c) for c in present]
    exprs += [F.count(F.lit(1)).alias(c) for c in fields if c not in df.columns]
    agg = df.agg(*exprs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in fields)
    return (agg.selectExpr(f"stack({len(fields)}, {pairs}) as (field, missing)")
            .filter(F.col("missing") > 0))


def conformity_rate(df: DataFrame, fields: list[str]) -> DataFrame:
    """(total - sum of missing required values) / total * 100, 2 dp."""
    present = [c for c in fields if c in df.columns]
    miss = sum((F.count_if(is_missing(df, c)) for c in present), F.lit(0))
    absent = len(fields) - len(present)
    total = F.count(F.lit(1))
    miss = miss + total * absent
    return df.agg(_pct(total - miss, total).alias("conformity_pct"))


def anomaly_texts(t_min: Column, t_max: Column, h_max: Column, p_min: Column,
                  variant: str = "local") -> Column:
    """Anomaly messages from extremes (array<string>, in rule order)."""
    # FIXED VALUES: thresholds and message texts.
    if variant == "local":
        items = [
            F.when(t_min < -50, F.concat(F.lit("Température min suspecte: "), num_text(t_min), F.lit("°C"))),
            F.when(t_max > 60, F.concat(F.lit("Température max suspecte: "), num_text(t_max), F.lit("°C"))),
            F.when(h_max > 100, F.concat(F.lit("Humidité > 100%: "), num_text(h_max))),
            F.when(p_min < 870, F.concat(F.lit("Pression min suspecte: "), num_text(p_min), F.lit(" hPa"))),
        ]
    else:
        items = [
            F.when(t_min < -50, F.concat(F.lit("Temp min: "), num_text(t_min), F.lit(" degC"))),
            F.when(t_max > 60, F.concat(F.lit("Temp max: "), num_text(t_max), F.lit(" degC"))),
        ]
    return F.array_compact(F.array(*items))


def anomalies(df: DataFrame, variant: str = "local") -> DataFrame:
    ext = df.agg(F.min(_finite_or_null(df, "temperature_c")).alias("t_min"),
                 F.max(_finite_or_null(df, "temperature_c")).alias("t_max"),
                 F.max(_finite_or_null(df, "humidity_pct")).alias("h_max"),
                 F.min(_finite_or_null(df, "pressure_hpa")).alias("p_min"))
    arr = anomaly_texts(F.col("t_min"), F.col("t_max"), F.col("h_max"), F.col("p_min"), variant)
    return ext.select(F.explode(arr).alias("anomaly"))


# ---------------------------------------------------------------------------
# combined reports

def _station_rollup(df: DataFrame, cols: list[str]) -> DataFrame:
    """One aggregation per (source, station_id): count, span, nulls, extremes."""
    return df.groupBy("source", "station_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("timestamp").alias("_ts_min"), F.max("timestamp").alias("_ts_max"),
        F.min(_finite_or_null(df, "temperature_c")).alias("_t_min"),
        F.max(_finite_or_null(df, "temperature_c")).alias("_t_max"),
        F.max(_finite_or_null(df, "humidity_pct")).alias("_h_max"),
        F.min(_finite_or_null(df, "pressure_hpa")).alias("_p_min"),
        *[F.count_if(is_missing(df, c)).alias(f"_null_{i}") for i, c in enumerate(cols)],
    )


def quality_report(df: DataFrame, variant: str = "local") -> DataFrame:
    """The transform's quality report in long form.

    ``variant='local'``: source counts keep nulls, duplicates count every
    member of a repeated key, four anomaly rules, key-null counts; empty
    input -> ``DataFrame vide``. ``variant='cloud'``: extras-only duplicates,
    two anomaly rules, empty -> ``Empty`` and nothing else.

    Two scans: (1) one partial+final aggregation per (source, station_id),
    rolled up by grouping sets (source / station / all) over that small
    result, feeding every section through one explode; (2) the key-count
    aggregation over the two key columns, which also carries the total and
    hence the empty-table form.
    """
    cols = UNIFIED_COLUMNS
    pre = _station_rollup(df, cols)
    roll = pre.groupingSets([["source"], ["station_id"], []], "source", "station_id").agg(
        F.grouping_id().alias("_gid"),
        F.sum("_n").alias("total"),
        F.min("_ts_min").alias("ts_min"), F.max("_ts_max").alias("ts_max"),
        F.min("_t_min").alias("t_min"), F.max("_t_max").alias("t_max"),
        F.max("_h_max").alias("h_max"), F.min("_p_min").alias("p_min"),
        *[F.sum(f"_null_{i}").alias(f"null_{i}") for i in range(len(cols))],
    )
    gid = F.col("_gid")  # 1: by source, 2: by station, 3: all rows
    total = F.col("total")
    facts = [_fact("total_records", None, total),
             _fact("date_range", "min", None, ts_text(F.col("ts_min"))),
             _fact("date_range", "max", None, ts_text(F.col("ts_max")))]
    facts += [_fact("null_rates", c, _pct(F.col(f"null_{i}"), total)) for i, c in enumerate(cols)]
    if variant == "local":
        facts += [_fact("invalid_timestamp", None, F.col(f"null_{cols.index('timestamp')}")),
                  _fact("missing_station_id", None, F.col(f"null_{cols.index('station_id')}"))]
    anom = F.transform(anomaly_texts(F.col("t_min"), F.col("t_max"), F.col("h_max"), F.col("p_min"), variant),
                       lambda a: _fact("anomalies", None, None, a))
    no_facts = F.array().cast(f"array<struct<{REPORT_SCHEMA.replace(' string', ':string').replace(' double', ':double')}>>")
    by_source = F.array(_fact("records_per_source", F.col("source"), total))
    by_station = F.array(_fact("records_per_station", F.col("station_id"), total))
    if variant == "cloud":  # null keys are not counted
        by_source = F.when(F.col("source").isNotNull(), by_source).otherwise(no_facts)
        by_station = F.when(F.col("station_id").isNotNull(), by_station).otherwise(no_facts)
    rows = (F.when(gid == 1, by_source).when(gid == 2, by_station)
            .otherwise(F.concat(F.array(*facts), anom)))
    main = roll.select(F.explode(rows).alias("f"))

    keys = df.select(*KEY_COLUMNS).groupBy(*KEY_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    dup = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                   F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dups_all"),
                   F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dups_extra"))
    dups = F.col("dups_all") if variant == "local" else F.col("dups_extra")
    empty_note = "DataFrame vide" if variant == "local" else "Empty"  # FIXED VALUE
    if variant == "local":
        empty = F.array(_fact("total_records", None, F.lit(0)),
                        _fact("date_range", "min"), _fact("date_range", "max"),
                        _fact("duplicates", None, F.lit(0)),
                        _fact("anomalies", None, None, F.lit(empty_note)))
    else:
        empty = F.array(_fact("total_records", None, F.lit(0)),
                        _fact("anomalies", None, None, F.lit(empty_note)))
    tail = dup.select(F.explode(F.when(F.col("total") > 0, F.array(_fact("duplicates", None, dups)))
                                .otherwise(empty)).alias("f"))
    return main.unionByName(tail).select("f.*")


def load_state(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mergeable state of a table: per (source, station) the rows, the span of
    times and the missing values of ``cols``, with one row of zeros, which
    stands for a table without rows. States of parts are merged by the same
    sums and extremes (:func:`post_load_sections`)."""
    total = F.count(F.lit(1))
    state = df.groupBy("source", "station_id").agg(
        total.alias("n"), F.min("timestamp").alias("ts_min"), F.max("timestamp").alias("ts_max"),
        *[(F.count_if(is_missing(df, c)) if c in df.columns else total).alias(f"m_{i}") for i, c in enumerate(cols)])
    zeros = ["CAST(NULL AS string) AS source", "CAST(NULL AS string) AS station_id", "0L AS n",
             "CAST(NULL AS timestamp_ntz) AS ts_min", "CAST(NULL AS timestamp_ntz) AS ts_max", *(f"0L AS m_{i}" for i in range(len(cols)))]
    return state.unionByName(df.sparkSession.range(1).selectExpr(*zeros))


def post_load_sections(state: DataFrame, cols: list[str], variant: str, required: list[str]) -> DataFrame:
    """The sections of A18 from a :func:`load_state`, by one grouping-sets rollup."""
    sets = [["source"], []] if variant == "strict" else [["source"], ["station_id"], []]
    sums = [F.sum(f"m_{i}").alias(f"m_{i}") for i in range(len(cols))]
    roll = state.groupingSets(sets, "source", "station_id").agg(
        F.grouping_id().alias("_gid"), F.sum("n").alias("total"), F.min("ts_min").alias("ts_min"), F.max("ts_max").alias("ts_max"), *sums)
    t, gid = F.col("total"), F.col("_gid")  # 1: by source, 2: by station, 3: all rows
    missing = {c: F.col(f"m_{i}") for i, c in enumerate(cols)}
    facts = [_fact("total_documents", None, t),
             _fact("date_range", "min", None, ts_text(F.col("ts_min"))),
             _fact("date_range", "max", None, ts_text(F.col("ts_max")))]
    whole = F.array(*facts)
    if variant == "strict":
        lost = sum((missing[c] for c in required), F.lit(0))
        rates = [_fact("schema_conformity_rate_pct", None, _pct(t - lost, t)),
                 *(_fact("null_rates_pct", c, _pct(missing[c], t)) for c in MEASURE_COLUMNS)]
        fields = F.filter(F.array(*[_fact("missing_required_fields", c, missing[c]) for c in required]), lambda f: f["num"] > 0)
        whole = F.concat(whole, F.array(*rates), fields)
    rows = (F.when(gid == 1, F.array(_fact("by_source", F.col("source"), t)))
            .when(gid == 2, F.array(_fact("by_station", F.col("station_id"), t))).otherwise(whole))
    return roll.filter((gid == 3) | (t > 0)).select(F.explode(rows).alias("f")).select("f.*")


def post_load_report(df: DataFrame, variant: str = "strict",
                     required: list[str] | None = None) -> DataFrame:
    """Report over a loaded table, long form, from one scan.

    ``strict`` (local loader): total, conformity %, non-zero missing counts of
    the required fields, null % of the 15 measures (0.0 when empty), counts by
    source, time span. ``core`` (cloud loader): total, by source, by station,
    time span.
    """
    from stratus.schema import RULESETS
    req = required or RULESETS["strict"]["required"]
    cols = list(dict.fromkeys([*req, *MEASURE_COLUMNS])) if variant == "strict" else []
    return post_load_sections(load_state(df, cols), cols, variant, req)


# ---------------------------------------------------------------------------
# K2: reports as JSON text

#: What a section of a JSON report holds: counts, numbers or texts by key, one
#: number, a list of texts, or a list of JSON objects.
COUNTS, NUMBERS, TEXTS, COUNT, NUMBER, LIST, OBJECTS = "counts", "numbers", "texts", "count", "number", "list", "objects"

QUALITY_LAYOUT = [
    ("total_records", COUNT), ("records_per_source", COUNTS), ("records_per_station", COUNTS), ("date_range", TEXTS), ("null_rates", NUMBERS),
    ("duplicates", COUNT), ("invalid_timestamp", COUNT), ("missing_station_id", COUNT), ("anomalies", LIST)]

LOAD_LAYOUT = [
    ("import", [("total_lines", COUNT), ("total_parsed", COUNT), ("total_submitted", COUNT), ("total_inserted", COUNT), ("total_errors", COUNT),
                ("error_types", COUNTS), ("errors_sample", OBJECTS), ("parse_errors_sample", OBJECTS)]),
    ("quality", [("total_documents", COUNT), ("schema_conformity_rate_pct", NUMBER), ("missing_required_fields", COUNTS),
                 ("null_rates_pct", NUMBERS), ("by_source", COUNTS), ("by_station", COUNTS), ("date_range", TEXTS)])]


def report_lines(facts: DataFrame, layout: list) -> DataFrame:
    """K2: long-form facts (section, key, num, txt) as the lines of one JSON
    document, ordered by (part, place, key): every fact is a line of its own, so a report
    over any number of stations is never one row. A null key is written as
    ``null``, together with a key of that name. Facts of a section without a
    place in ``layout`` are left out; sections without facts are empty or null."""
    static, places = [], []

    def walk(items, depth):
        for i, (name, kind) in enumerate(items):
            pad, comma = "  " * depth, "," if i else ""
            if isinstance(kind, list):
                static.append((len(static) + len(places), 0, f'{pad}{comma}"{name}": {{'))
                walk(kind, depth + 1)
                static.append((len(static) + len(places), 0, f"{pad}}}"))
            else:
                places.append((name, kind, len(static) + len(places), pad, comma))

    static.append((0, 0, "{"))
    walk(layout, 1)
    static.append((len(static) + len(places), 0, "}"))
    schema = "part int, place int, line string, key string"
    lines = facts.sparkSession.createDataFrame([(*row, None) for row in static], schema)
    for name, kind, part, pad, comma in places:
        own = facts.filter(F.col("section") == name)
        quoted = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
        count = F.col("num").cast("decimal(38,0)").cast("string")
        if kind in (COUNT, NUMBER):
            value = F.max(count if kind == COUNT else F.col("num").cast("string"))
            one = own.agg(F.coalesce(value, F.lit("null")).alias("value"))
            lines = lines.union(one.select(F.lit(part), F.lit(0), F.concat(F.lit(f'{pad}{comma}"{name}": '), "value"), F.lit(None).cast("string")))
            continue
        if kind in (COUNTS, NUMBERS, TEXTS):
            merged = own.groupBy(F.coalesce("key", F.lit("null")).alias("key")).agg(
                F.sum("num").alias("num"), F.max("txt").alias("txt"))
            value = count if kind == COUNTS else F.col("num").cast("string") if kind == NUMBERS else quoted("txt")
            rows = merged.select("key", F.concat(quoted("key"), F.lit(": "), F.coalesce(value, F.lit("null"))).alias("line"))
        else:
            rows = own.select(F.coalesce("key", "txt").alias("key"), (quoted("txt") if kind == LIST else F.col("txt")).alias("line"))
        first = rows.agg(F.min("key")).scalar()
        ends = ("{", "}") if kind in (COUNTS, NUMBERS, TEXTS) else ("[", "]")
        around = [(part, 0, f'{pad}{comma}"{name}": {ends[0]}', None), (part, 2, pad + ends[1], None)]
        entries = rows.select(F.lit(part), F.lit(1), F.concat(F.lit(f"{pad}  "), F.when(F.col("key") == first, "").otherwise(","), "line"), "key")
        lines = lines.union(facts.sparkSession.createDataFrame(around, schema)).union(entries)
    return lines
