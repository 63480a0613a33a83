"""The user-level jobs, each one lazy plan from scan to write.

* :func:`cloud_transform` (E2): wrapped JSON-lines under a prefix -> unified,
  deduplicated rows.
* :func:`local_transform` (E1): nested documents + sheet files -> unified rows.
* :func:`load` (E3): unified JSON-lines -> validated, key-checked rows with a
  status per row; :func:`run_load` writes them and reports.
* :func:`post_load_check` (E4): counts, span and a sample row of a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratus.functions.text import truncate
from stratus.operators.dedup import dedup_keep_first
from stratus.functions.time import date_from_path
from stratus.operators.normalize import (
    WRAPPER_KEY, detect_source, infer_station, project_by_kind, require_sheet_columns, sheet_rows, union_sources, with_payload,
)
from stratus.operators.quality import LOAD_LAYOUT, QUALITY_LAYOUT, REPORT_SCHEMA, post_load_report, quality_report
from stratus.operators.validate import classify, normalize_documents, parse_documents
from stratus.schema import INFOCLIMAT_FIELDS, KEY_COLUMNS, UNIFIED_COLUMNS
from stratus.session import cut_lineage
from stratus.sinks.tables import (
    _existing_keys, export_jsonl, insert_ignore_plan, read_unified, replace_path, scan_table, write_layout, write_report,
)
from stratus.sources.document import document_quarantine, explode_documents, files_stage, read_documents
from stratus.sources.jsonl import line_numbers, nonblank, parse_records, require_rows, scan_lines

ORDER = ["file_path", "split_start", "row_id"]


# ---------------------------------------------------------------------------
# E2

def numeric_code(text: Column, payload: Column) -> Column:
    """True where the payload's weather code is a JSON number, which stays one in
    the export. ``text`` is the payload as JSON; its last such key counts."""
    key = next(k for k, v in INFOCLIMAT_FIELDS.items() if v == "weather_code")
    first = F.regexp_extract(text, rf'(?s).*"{key}"\s*:\s*(.)', 1)
    return F.when(payload.getItem(key).isNotNull(), first.rlike("[-0-9]")).otherwise(F.lit(False))


def cloud_stage(lines: DataFrame) -> DataFrame:
    """S1 blank drop -> S2 parse -> P1 unwrap, stored: every line is parsed once,
    and every payload once, whatever reads the stage.

    Columns: order columns, ``rel_path``, ``error`` (why a line is unusable) with
    the line as ``raw``, else ``payload``, ``kind_code`` and ``weather_code_number``.
    """
    staged = with_payload(parse_records(nonblank(lines)))
    text = F.coalesce(F.col("rec").getItem(WRAPPER_KEY), F.col("value"))
    return cut_lineage(staged.select(*ORDER, "rel_path", "error", F.when(F.col("error").isNotNull(), F.col("value")).alias("raw"),
                                     "payload", "kind_code", numeric_code(text, F.col("payload")).alias("weather_code_number")), "parsed")


def unusable_lines(stage: DataFrame) -> DataFrame:
    """The quarantine of a stored stage: position, reason and the whole line."""
    return stage.filter(F.col("error").isNotNull()).select(*ORDER, "error", "raw")


def cloud_records(lines: DataFrame, detect: str = "file", date_order: str = "DMY", stage: DataFrame | None = None) -> DataFrame:
    """The usable records of :func:`cloud_stage` with their P8 kind (per file by
    default), the per-file station (P20) and path date (X10)."""
    stage = cloud_stage(lines) if stage is None else stage
    good = stage.filter(F.col("error").isNull()).drop("error", "raw")
    attrs = {"file_station": infer_station(F.col("rel_path")),
             "file_date": date_from_path(F.col("rel_path"), date_order)}
    return detect_source(good, "payload", per=detect, file_attrs=attrs)


def cloud_transform(lines: DataFrame, date_order: str = "DMY", dedup: bool = True,
                    detect: str = "file", stage: DataFrame | None = None) -> DataFrame:
    """Lines (file_path, split_start, row_id, value, rel_path) -> unified
    rows, keep-first dedup on (station_id, timestamp) in input order."""
    recs = cloud_records(lines, detect, date_order, stage)
    rows = project_by_kind(recs, "payload", "kind", "rel_path", date_order)
    if dedup:
        rows = dedup_keep_first(rows, KEY_COLUMNS, ORDER)
    return rows


def run_cloud(spark: SparkSession, input_root: str, output_dir: str, date_order: str = "DMY") -> DataFrame:
    """E2 end to end: scan the prefix, transform, write JSONL, the lines that
    could not be used, and the report."""
    lines = scan_lines(spark, input_root)
    stage = cloud_stage(lines)
    return _export(spark, cloud_transform(lines, date_order, stage=stage), unusable_lines(stage), output_dir, "cloud",
                   f"nothing parsed under {input_root}")


def _export(spark: SparkSession, out: DataFrame, unusable: DataFrame, output_dir: str, form: str, empty: str) -> DataFrame:
    """Write the export aside, in input order, and put it in place only if there
    are rows; an earlier export stays when there is nothing to write. The rows
    are stored first: the ranges of the order, the export and the guard read
    them, so the transform runs once. The report reads the written export."""
    target = f"{output_dir}/weather_data"
    rows = require_rows(cut_lineage(out, "transformed"), empty)
    aside = f"{target}.{uuid.uuid4().hex[:12]}"
    export_jsonl(rows, aside, order=tuple(c for c in ("_part", *ORDER) if c in rows.columns))
    replace_path(spark, aside, target)
    written = read_unified(spark, target)
    unusable.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{target}.quarantine")
    write_report(quality_report(written, form), f"{target}.quality", QUALITY_LAYOUT)
    return written


# ---------------------------------------------------------------------------
# E1

def sheet_stage(sheets: DataFrame) -> DataFrame:
    """S2 on sheet lines, stored: the sheets' check and their rows read one parse."""
    parsed = parse_records(nonblank(sheets))
    return cut_lineage(parsed.select(*ORDER, F.col("parse_error").alias("error"),
                                     F.when(F.col("parse_error").isNotNull(), F.col("value")).alias("raw"), F.col("rec").alias("payload")), "sheets")


def local_transform(docs: DataFrame, sheets: DataFrame, sheet_station=None, stage: DataFrame | None = None,
                    elements: DataFrame | None = None) -> DataFrame:
    """Nested documents (file_path, value) + sheet lines -> unified rows,
    no dedup. ``sheet_station`` maps a sheet file to its station id (default:
    the name of the folder holding the sheet)."""
    ic = explode_documents(docs, elements)
    stage = sheet_stage(sheets) if stage is None else stage
    if sheet_station is None:
        sheet_station = F.regexp_extract(F.col("file_path"), r"([^/]+)/[^/]+$", 1)
    wu = sheet_rows(stage.filter(F.col("error").isNull()), sheet_station, "payload")
    return union_sources(ic, wu).select("_part", *ORDER, *UNIFIED_COLUMNS)


def run_local(spark: SparkSession, docs_root: str, sheets_root: str, output_dir: str, require_columns: bool = False) -> DataFrame:
    """E1 end to end: documents and sheets -> JSONL, what could not be used, the report.

    ``require_columns``: a sheet that lacks a column is an error (sheets that
    were landed without their empty cells lose the columns of them)."""
    docs, sheets = read_documents(spark, docs_root), scan_lines(spark, sheets_root)
    stage = sheet_stage(sheets)
    if require_columns:
        require_sheet_columns(stage.filter(F.col("error").isNull()))
    elements = files_stage(spark, docs_root)
    unusable = (document_quarantine(docs, stage=elements).select("file_path", F.lit(None).cast("long").alias("split_start"),
                                                 F.col("rec_pos").cast("long").alias("row_id"), "error", "raw")
                .unionByName(unusable_lines(stage)))
    return _export(spark, local_transform(docs, sheets, stage=stage, elements=elements), unusable, output_dir, "local", "no input rows")


# ---------------------------------------------------------------------------
# E3

def load(lines: DataFrame, ruleset: str = "strict", zone: str = "convert",
         existing: DataFrame | None = None, unique: bool = True, names: str = "local") -> DataFrame:
    """E3 plan: every non-blank line with its outcome.

    Columns: order columns, ``pos`` (input order), the 23 typed columns,
    ``violations``, ``parse_error``, ``duplicate``, ``status``
    (``parse_error`` / ``inserted`` / ``rejected``) and ``reject_type``.
    A row failing the rules is a schema rejection even if its key repeats.
    """
    docs = parse_documents(nonblank(lines)).withColumn("pos", F.struct(*ORDER))
    keep = (*ORDER, "pos", "parse_error")
    rows = cut_lineage(normalize_documents(docs, ruleset, zone, keep=keep))
    parsed_ok = F.col("parse_error").isNull()
    valid = parsed_ok & (F.size("violations") == 0)
    if unique:
        tagged = insert_ignore_plan(rows, existing, order="pos", valid=valid)
    else:
        tagged = rows.withColumn("duplicate", F.lit(False))
    status = (F.when(~parsed_ok, F.lit("parse_error"))
              .when(valid & ~F.col("duplicate"), F.lit("inserted"))
              .otherwise(F.lit("rejected")))
    rtype = F.when(parsed_ok, classify("violations", F.col("duplicate"), names))
    return tagged.withColumn("status", status).withColumn("reject_type", rtype)


def import_accounting(outcome: DataFrame, names: str = "local") -> DataFrame:
    """Lines, parsed, submitted, inserted, errors, errors by type (under the
    type names in use) - one pass."""
    st = F.col("status")
    # FIXED VALUES: type names of the two loaders.
    types = ("schema_validation", "duplicate_key") if names == "local" else ("validation", "duplicate", "other")
    return outcome.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(st != "parse_error").alias("total_parsed"),
        F.count_if(st != "parse_error").alias("total_submitted"),
        F.count_if(st == "inserted").alias("total_inserted"),
        F.count_if(st == "rejected").alias("total_errors"),
        *[F.count_if((st == "rejected") & F.coalesce(F.col("reject_type"), F.lit("other")).eqNullSafe(t)).alias(t) for t in types],
    )


def rejection_messages(outcome: DataFrame, chars: int = 250) -> DataFrame:
    """Rejected rows with a message: violated rules, or the duplicate key."""
    msg = F.when(F.size("violations") > 0, F.concat(F.lit("failed validation: "),
                                                    F.array_join("violations", ", "))) \
        .otherwise(F.concat(F.lit("duplicate key: "), F.coalesce(F.col("station_id"), F.lit("null")),
                            F.lit(" "), F.coalesce(F.col("timestamp").cast("string"), F.lit("null"))))
    return (outcome.filter(F.col("status") == "rejected")
            .withColumn("message", truncate(msg, chars)))


def parse_error_sample(lines: DataFrame, outcome: DataFrame, n: int = 10, chars: int = 200) -> DataFrame:
    """T5: the first ``n`` lines in input order that are no JSON objects, with
    their line numbers in the file (blank lines counted)."""
    bad = outcome.filter(F.col("status") == "parse_error").orderBy(*ORDER).limit(n).select(*ORDER, F.col("parse_error").alias("error"))
    at = [F.col(f"l.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ORDER]
    found = bad.alias("b").join(lines.alias("l"), at).select("b.*", truncate("l.value", chars).alias("raw"))
    return line_numbers(lines, found).select(*ORDER, F.col("line_no").alias("line"), "error", "raw")


def load_facts(lines: DataFrame, outcome: DataFrame, table: DataFrame, names: str, variant: str, samples: bool = True) -> DataFrame:
    """The import and post-load report of E3 in long form; with both error samples as JSON objects."""
    acct = import_accounting(outcome, names)
    types = {"schema_validation", "duplicate_key", "validation", "duplicate", "other"}
    facts = acct.select(F.explode(F.array(*[
        F.struct(F.lit("error_types" if samples and c in types else c if samples else "import").alias("section"), F.lit(c).alias("key"),
                 F.col(c).cast("double").alias("num"), F.lit(None).cast("string").alias("txt"))
        for c in acct.columns])).alias("f")).select("f.*")
    facts = facts.unionByName(post_load_report(table, variant))
    if not samples:
        return facts
    place = F.concat_ws(" ", F.col("file_path"), F.lpad(F.col("split_start").cast("string"), 20, "0"), F.lpad(F.col("row_id").cast("string"), 20, "0"))
    rejects = rejection_messages(outcome).orderBy("pos").limit(15)
    rejects = rejects.select(F.lit("errors_sample").alias("section"), place.alias("key"), F.lit(None).cast("double").alias("num"),
                             F.to_json(F.struct(F.col("row_id").alias("row"), F.col("reject_type").alias("type"), "message")).alias("txt"))
    parse = parse_error_sample(lines, outcome)
    parse = parse.select(F.lit("parse_errors_sample").alias("section"), place.alias("key"), F.lit(None).cast("double").alias("num"),
                         F.to_json(F.struct("line", "error", "raw")).alias("txt"))
    # types without an error are not listed
    return facts.filter((F.col("section") != "error_types") | (F.col("num") > 0)).unionByName(rejects).unionByName(parse)


def run_load(spark: SparkSession, lines: DataFrame, table_path: str, mode: str = "reset",
             ruleset: str = "strict", zone: str = "convert", names: str = "local", report_path: str | None = None) -> DataFrame:
    """E3 end to end: validate, insert (reset = overwrite, append = insert-or-
    ignore vs stored keys), return the long-form import + post-load report; with
    ``report_path`` also written as one JSON file with both error samples.
    The cloud loader is ``ruleset="core", zone="drop", names="cloud"``."""
    existing = None if mode == "reset" else _existing_keys(spark, table_path)
    # the validated stage and the marked keys inside ``load`` are already stored,
    # so reading the outcome again joins them, no more
    outcome = load(lines, ruleset, zone, existing=existing, names=names)
    inserted = outcome.filter(F.col("status") == "inserted").select(*UNIFIED_COLUMNS)
    write_layout(inserted, table_path, "overwrite" if mode == "reset" else "append")
    table = scan_table(spark, table_path).select(*UNIFIED_COLUMNS)  # declared schema: an empty table is one too
    variant = "strict" if ruleset == "strict" else "core"
    if report_path:
        write_report(load_facts(lines, outcome, table, names, variant), report_path, LOAD_LAYOUT)
    return load_facts(lines, outcome, table, names, variant, samples=False)


# ---------------------------------------------------------------------------
# E4

def post_load_check(table: DataFrame, sample_source: str = "weather_underground") -> DataFrame:
    """Total, by source, by station, span, one sample row (empty table ok)."""
    from stratus.operators.queries import sample_row
    rep = post_load_report(table, "core")
    s = sample_row(table, sample_source, order=UNIFIED_COLUMNS)
    def fact(key, num, txt):
        return F.struct(F.lit("sample").alias("section"), F.lit(key).alias("key"),
                        num.cast("double").alias("num"), txt.cast("string").alias("txt"))
    sample = s.select(F.explode(F.array(
        fact("station_id", F.lit(None), F.col("station_id")),
        fact("temperature_c", F.col("temperature_c"), F.lit(None)),
        fact("timestamp", F.lit(None), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")),
    )).alias("f")).select("f.*")
    return rep.unionByName(sample)


__all__ = ["cloud_transform", "run_cloud", "local_transform", "run_local", "load", "import_accounting",
           "rejection_messages", "run_load", "post_load_check", "REPORT_SCHEMA"]
