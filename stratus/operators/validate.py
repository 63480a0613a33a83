"""Declarative rule sets -> per-row violations.

A document is a struct with one VARIANT per field (SQL null: the field is
absent). From it come three arrays, in the order of the fields: ``codes`` (the
first letters of each value's type), ``nums`` (of numeric fields) and ``texts``
(of the others). A rule set is
checked twice over: one compiled condition tells rows that conform, and only the
other rows are walked through with the rules as data, to name what they break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratus.functions.time import iso_timestamp
from stratus.schema import RULESETS, UNIFIED_SCHEMA
from stratus.sources.jsonl import in_array, line_mark, parse_error

INT32_MAX = 2**31 - 1

# first letters of ``schema_of_variant`` -> JSON/BSON type tag
_TYPE_TAGS = {
    "BIG": "int", "INT": "int", "SMA": "int", "TIN": "int",
    "DEC": "double", "DOU": "double", "FLO": "double",
    "STR": "string", "VOI": "null", "BOO": "bool", "OBJ": "object", "ARR": "array",
}
_NUMBERS = [code for code, tag in _TYPE_TAGS.items() if tag in ("int", "double")]
_INTEGERS = [code for code, tag in _TYPE_TAGS.items() if tag == "int"]

UNIFIED_FIELDS = [f.name for f in UNIFIED_SCHEMA.fields]
NUMERIC = frozenset(f.name for f in UNIFIED_SCHEMA.fields if isinstance(f.dataType, T.NumericType))


def parse_documents(lines: DataFrame, fields: list[str] = UNIFIED_FIELDS) -> DataFrame:
    """S8 (raw form): each non-blank line as ``doc``, its ``fields`` as VARIANT;
    ``parse_error`` for lines that are not JSON objects.

    Of a repeated key the last value counts. An object *inside* a value that
    repeats a key makes the line invalid, unless the session allows such values
    (``spark.sql.variant.allowDuplicateKeys``).
    """
    schema = "array<struct<" + ", ".join(f"`{f}`: variant" for f in fields) + ", `_mark`: string>>"
    parsed = lines.withColumn("_one", F.from_json(in_array("value", "_mark"), schema))
    alone = F.coalesce((F.size("_one") == 2) & (F.get("_one", F.lit(1))["_mark"] == line_mark("value")), F.lit(False))
    parsed = parsed.withColumn("doc", F.when(alone, F.get("_one", F.lit(0)))).drop("_one")
    return parsed.withColumn("parse_error", parse_error("doc"))


# The expressions below are written as SQL text: there are hundreds of them, and
# one call to the parser is cheaper than a call to the JVM for every node.

def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def with_values(docs: DataFrame, fields: list[str], doc: str = "doc") -> DataFrame:
    """Add ``codes``, ``nums`` and ``texts`` of the fields of ``doc``."""
    def only(codes, f, i, kind, wanted):
        # numbers by their text: a VARIANT decimal is cast to double through a new expression per value
        text = f"try_variant_get({doc}.`{f}`, '$', 'string')"
        return f"CASE WHEN codes[{i}] IN ({_list(codes)}) THEN CAST({text} AS {kind}) END" if wanted else f"CAST(NULL AS {kind})"

    docs = docs.withColumn("codes", F.expr("array(" + ", ".join(f"left(schema_of_variant({doc}.`{f}`), 3)" for f in fields) + ")"))
    nums = ", ".join(only(_NUMBERS, f, i, "double", f in NUMERIC) for i, f in enumerate(fields))
    texts = ", ".join(only(["STR"], f, i, "string", f not in NUMERIC) for i, f in enumerate(fields))
    return docs.withColumns({"nums": F.expr(f"array({nums})"), "texts": F.expr(f"array({texts})")})


def tags_sql(fields: list[str], widen: list[str]) -> str:
    """The JSON/BSON type tags of all fields (null: absent), from ``codes`` and
    ``nums``. Integers of ``widen`` fields count as double (X14); integers
    beyond 32 bits of other numeric fields are ``long``."""
    spec = ", ".join(f"struct({i} AS at, {f in widen} AS widen, {f in NUMERIC} AS numeric)" for i, f in enumerate(fields))
    tags = "map(" + ", ".join(f"'{code}', '{tag}'" for code, tag in _TYPE_TAGS.items()) + ")"
    integer = f"codes[s.at] IN ({_list(_INTEGERS)})"
    return (f"transform(array({spec}), s -> CASE WHEN codes[s.at] IS NULL THEN NULL WHEN s.widen AND {integer} THEN 'double' "
            f"WHEN s.numeric AND {integer} AND abs(nums[s.at]) > {INT32_MAX} THEN 'long' "
            f"ELSE coalesce(try_element_at({tags}, codes[s.at]), 'other') END)")


def conforms_sql(fields: list[str], ruleset: str | dict, timestamp: str) -> str:
    """True where a row breaks no rule. ``timestamp`` names the parsed field,
    which is always present, as a date or null."""
    rs = RULESETS[ruleset] if isinstance(ruleset, str) else ruleset
    at = fields.index
    checks = [f"codes[{at(f)}] IS NOT NULL" for f in rs["required"] if f != "timestamp"]
    for f, (types, lo, hi) in rs["properties"].items():
        i = at(f)
        if f == "timestamp":
            checks += [] if "null" in types else [f"{timestamp} IS NOT NULL"]
            continue
        allowed = [c for c, t in _TYPE_TAGS.items() if t in types or (t == "int" and f in rs["widen"] and "double" in types)]
        checks.append(f"(codes[{i}] IS NULL OR codes[{i}] IN ({_list(allowed)}))")
        if f in NUMERIC and f not in rs["widen"] and "int" in types and "long" not in types:
            checks.append(f"coalesce(codes[{i}] NOT IN ({_list(_INTEGERS)}) OR abs(nums[{i}]) <= {INT32_MAX}, true)")
        checks += [f"coalesce(nums[{i}] {op} double({limit}), true)" for op, limit in ((">=", lo), ("<=", hi)) if limit is not None]
    checks += [f"(codes[{at(f)}] IS NULL OR coalesce(texts[{at(f)}] IN ({_list(values)}), false))" for f, values in rs.get("enum", {}).items()]
    return " AND ".join(checks) or "true"


def violations_sql(tags: str, fields: list[str], ruleset: str | dict = "strict") -> str:
    """The labels of all violated rules of a row, in rule order:
    required fields, then types and limits by field, then enums."""
    rs = RULESETS[ruleset] if isinstance(ruleset, str) else ruleset
    out = ["CAST(array() AS array<string>)"]
    if rs["required"]:                                                 # P9
        rules = ", ".join(f"struct({fields.index(f)} AS at, '{f}' AS name)" for f in rs["required"])
        out.append(f"transform(filter(array({rules}), r -> {tags}[r.at] IS NULL), r -> 'required:' || r.name)")
    if rs["properties"]:                                               # P10, P11
        limit = lambda v: "CAST(NULL AS double)" if v is None else f"double({v})"
        rules = ", ".join(f"struct({fields.index(f)} AS at, '{f}' AS name, array({_list(types)}) AS types, {limit(lo)} AS lo, {limit(hi)} AS hi)"
                          for f, (types, lo, hi) in rs["properties"].items())
        number = f"{tags}[r.at] IN ('int', 'long', 'double')"
        out.append(f"flatten(transform(array({rules}), r -> array_compact(array("
                   f"CASE WHEN NOT array_contains(r.types, {tags}[r.at]) THEN 'type:' || r.name END, "
                   f"CASE WHEN {number} AND nums[r.at] < r.lo THEN 'minimum:' || r.name END, "
                   f"CASE WHEN {number} AND nums[r.at] > r.hi THEN 'maximum:' || r.name END))))")
    if rs.get("enum"):                                                 # P12
        rules = ", ".join(f"struct({fields.index(f)} AS at, '{f}' AS name, array({_list(values)}) AS values)" for f, values in rs["enum"].items())
        out.append(f"transform(filter(array({rules}), r -> {tags}[r.at] IS NOT NULL AND NOT coalesce("
                   f"{tags}[r.at] = 'string' AND array_contains(r.values, texts[r.at]), false)), r -> 'enum:' || r.name)")
    return f"concat({', '.join(out)})"


def classify(violations_col: str = "violations", duplicate: Column | None = None,
             names: str = "local") -> Column:
    """Rejection type; a schema failure wins over a duplicate key."""
    # FIXED VALUES: type names of the two loaders.
    schema_name, dup_name = ("schema_validation", "duplicate_key") if names == "local" else ("validation", "duplicate")
    c = F.when(F.size(violations_col) > 0, F.lit(schema_name))
    if duplicate is not None:
        c = c.when(duplicate, F.lit(dup_name))
    return c


def normalize_documents(docs: DataFrame, ruleset: str = "strict", zone: str = "convert",
                        keep: tuple[str, ...] = ("pos",)) -> DataFrame:
    """X13 + X14 + P13 on parsed documents: typed unified columns plus
    ``violations``. Values of a wrong type become null in the typed columns
    (the row is rejected anyway)."""
    rs = RULESETS[ruleset]
    fields = UNIFIED_FIELDS
    rows = with_values(docs.select(*keep, "doc"), fields).drop("doc")
    at = fields.index("timestamp")
    rows = rows.withColumn("_ts", iso_timestamp(F.get("texts", F.lit(at)), zone))
    rows = rows.withColumn("_ok", F.expr(conforms_sql(fields, ruleset, "_ts")))
    date = "CASE WHEN _ts IS NULL THEN 'null' ELSE 'date' END"
    rows = rows.withColumn("_tags", F.expr(f"CASE WHEN NOT _ok THEN transform({tags_sql(fields, rs['widen'])}, (t, i) -> CASE WHEN i = {at} THEN {date} ELSE t END) END"))

    def typed(f: T.StructField) -> str:
        i = fields.index(f.name)
        c = "_ts" if i == at else f"{'nums' if f.name in NUMERIC else 'texts'}[{i}]"
        return f"CAST({c} AS {f.dataType.simpleString()}) AS `{f.name}`"

    broken = f"CASE WHEN _ok THEN CAST(array() AS array<string>) ELSE {violations_sql('_tags', fields, ruleset)} END AS violations"
    return rows.selectExpr(*keep, *map(typed, UNIFIED_SCHEMA.fields), broken)
