"""JSON-lines scan, tolerant parse with quarantine, accounting.

A *lines* frame has the columns ``file_path`` (file URI or logical path),
``split_start`` (byte offset of the split the line came from), ``row_id``
(increasing within a split) and ``value`` (the raw line). The triple
(file_path, split_start, row_id) orders lines as they appear in the input.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from stratus.functions.text import is_blank, truncate

LINES_COLUMNS = ["file_path", "split_start", "row_id", "value"]
ORDER = ["file_path", "split_start", "row_id"]


SCHEME_RE = r"^[A-Za-z][\w+.-]*:/*"


def resolved_root(spark: SparkSession, root: str) -> str:
    """The scan root as the file system names it, encoded like file URIs are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().toString().rstrip("/")


def relative_path(file_path: Column, root: str) -> Column:
    """Path of a file relative to the resolved scan root, decoded, with a leading
    ``/`` (H6). A file that is not under the root is an error."""
    prefix = re.sub(SCHEME_RE, "/", root)
    path = F.regexp_replace(file_path, SCHEME_RE, "/")
    tail = F.url_decode(F.replace(F.substr(path, F.lit(len(prefix) + 1)), F.lit("+"), F.lit("%2B")))
    return F.when(path.startswith(prefix + "/"), tail).otherwise(
        F.raise_error(F.concat(F.lit(f"not under {root}: "), file_path)))


def scan_lines(spark: SparkSession, root: str, glob: str = "*.{jsonl,json}",
               recursive: bool = True) -> DataFrame:
    """Every line of every matching file under ``root``, all levels.

    Adds ``rel_path`` (path under ``root``). Blank lines are kept here so that
    positions count them; use :func:`nonblank` to drop them.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(root)
    return df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    ).withColumn("rel_path", relative_path(F.col("file_path"), resolved_root(spark, root)))


def nonblank(lines: DataFrame) -> DataFrame:
    """Drop lines that are empty after trimming."""
    return lines.filter(~is_blank("value"))


def parse_records(lines: DataFrame, col: str = "rec") -> DataFrame:
    """Parse each line as a JSON object into ``MAP<STRING,STRING>``.

    Nested objects stay as JSON text; of a repeated key the last value counts.
    A line that is not exactly one JSON object gives a null ``rec`` and
    ``parse_error`` explains why. The plan parses a line once; who uses the
    result more than once stores it (:func:`stratus.plans.pipelines.cloud_stage`),
    as the optimizer repeats the parse in every filter that it pushes down.
    """
    parsed = lines.withColumn("_one", F.from_json(in_array("value"), "array<map<string,string>>"))
    parsed = parsed.withColumn(col, F.when(only_element("_one"), last_values(F.get("_one", F.lit(0))))).drop("_one")
    return parsed.withColumn("parse_error", parse_error(col))


def parse_error(rec: str) -> Column:
    """Why a line has no record: only such lines are looked at again."""
    other = F.try_variant_get(F.try_parse_json(in_array("value")), "$", "array<variant>")
    mark = F.try_variant_get(F.get(other, F.lit(1)), "$", "map<string,variant>")
    json = F.coalesce((F.size(other) == 2) & F.map_contains_key(mark, line_mark("value")), F.lit(False))
    is_object = F.coalesce(F.schema_of_variant(F.get(other, F.lit(0))).startswith("OBJECT"), F.lit(False))
    return F.when(F.col(rec).isNull(), F.when(json & ~is_object, F.lit("not a JSON object")).otherwise(F.lit("invalid JSON")))


def line_mark(value) -> Column:
    """A key that the text itself does not hold: its own hash."""
    return F.hex(F.xxhash64(value))


def in_array(value, key: str | None = None) -> Column:
    """The text as first element of a JSON array, before an object that holds
    its mark, as a key or as the value of ``key``. Text behind a first value is an error or a further element, and a
    text that ends the array early leaves the mark outside (:func:`only_element`)."""
    mark = (F.lit(',{"'), line_mark(value), F.lit('":null}]')) if key is None else (F.lit(f',{{"{key}":"'), line_mark(value), F.lit('"}]'))
    return F.concat(F.lit("["), F.col(value), *mark)


def only_element(parsed: str) -> Column:
    """True if an array of :func:`in_array`, read as maps, holds the text's value and the mark, no more."""
    held = (F.size(parsed) == 2) & F.map_contains_key(F.get(parsed, F.lit(1)), line_mark("value"))
    return F.coalesce(held, F.lit(False))


def last_values(rec: Column) -> Column:
    """The map with the last value of each repeated key."""
    keys = F.map_keys(rec)
    own = F.array_distinct(keys)
    last = lambda k: F.element_at(F.filter(F.map_entries(rec), lambda e: e["key"] == k), -1)["value"]
    return F.when(F.size(own) == F.size(keys), rec).otherwise(F.map_from_arrays(own, F.transform(own, last)))


def quarantine(parsed: DataFrame, raw_chars: int | None = None) -> DataFrame:
    """Rejected lines: position, reason and the line (its first ``raw_chars`` characters)."""
    raw = F.col("value") if raw_chars is None else truncate("value", raw_chars)
    return parsed.filter(F.col("parse_error").isNotNull()).select(*ORDER, F.col("parse_error").alias("error"), raw.alias("raw"))


def rows_per_file(parsed: DataFrame) -> DataFrame:
    """Parsed records per file (one partial+final aggregate)."""
    return (parsed.filter(F.col("parse_error").isNull())
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("records")))


def line_numbers(lines: DataFrame, subset: DataFrame) -> DataFrame:
    """1-based line numbers (blank lines counted) for the rows of ``subset``.

    Lines of one split carry consecutive ``row_id`` values, so a line's number
    is the count of lines in earlier splits of its file plus its offset in the
    split. Only per-split counts are aggregated (one row per split); the big
    frame is never ranked as a whole.
    """
    splits = lines.groupBy("file_path", "split_start").agg(
        F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("file_path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    return (subset.join(offsets, ["file_path", "split_start"], "left")
            .withColumn("line_no", F.col("before") + F.col("row_id") - F.col("first_row") + 1)
            .drop("first_row", "n", "before"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise on the driver when ``df`` has no rows (cheap: stops at one row)."""
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df
