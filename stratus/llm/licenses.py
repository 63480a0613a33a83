"""License scan with ordered signature rules.

Every rule is a regular expression over a text's words, gated by a keyword that
must stand in the text. The rules are written per license: its name, its
identifiers, its versions and sentences of its notice; the templates below
spell them out into some hundreds of expressions. All detections of a text are
intervals of words. A detection inside an interval of a higher priority, or
inside a longer one of the same priority, is suppressed.

Everything is done within the row by SQL functions: no shuffle, no join, no
Python. Edge cases: a null or empty text has no words and no detection (score
0); rows with repeated or null ids are scanned like any others; further columns
are kept by :func:`scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import ascii_lower

# The phrases and labels of the contract.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: (label, keyword, name, versions), the keyword in every match of the name: a version v adds "-v" to the label; "" is the license without one.
LICENSES = (
    ("gpl", "gnu general public", r"gnu general public licen[cs]e", ("", "1", "2", "3")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("", "1", "2", "3")),
    ("lgpl", "general public licen", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", ("", "2", "2.1", "3")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("", "2", "2.1", "3")),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", ("", "1", "3")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("", "3")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e", ("", "1.1", "1.2", "1.3")),
    ("apache", "apache", r"apache (?:software )?licen[cs]e", ("", "1.0", "1.1", "2.0")),
    ("mit", "mit licen", r"(?:the )?mit licen[cs]e", ("",)),
    ("mit", "expat", r"expat licen[cs]e", ("",)),
    ("bsd", "bsd", r"(?:modified |simplified |new |revised )?bsd licen[cs]e", ("",)),
    ("bsd-2-clause", "2 clause", r"(?:bsd 2 clause|2 clause bsd)(?: licen[cs]e)?", ("",)),
    ("bsd-3-clause", "3 clause", r"(?:bsd 3 clause|3 clause bsd)(?: licen[cs]e)?", ("",)),
    ("bsd-4-clause", "4 clause", r"(?:bsd 4 clause|4 clause bsd)(?: licen[cs]e)?", ("",)),
    ("isc", "isc licen", r"isc licen[cs]e", ("",)),
    ("mpl", "mozilla public", r"mozilla public licen[cs]e", ("", "1.0", "1.1", "2.0")),
    ("epl", "eclipse public", r"eclipse public licen[cs]e", ("", "1.0", "2.0")),
    ("cddl", "common development", r"common development and distribution licen[cs]e", ("", "1.0", "1.1")),
    ("cpl", "common public", r"common public licen[cs]e", ("", "1.0")),
    ("artistic", "artistic licen", r"artistic licen[cs]e", ("", "1.0", "2.0")),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", ("",)),
    ("bsl", "boost software", r"boost software licen[cs]e", ("", "1.0")),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ("",)),
    ("wtfpl", "wtfpl", r"wtfpl", ("", "2")),
    ("ofl", "open font", r"(?:sil )?open font licen[cs]e", ("", "1.0", "1.1")),
    ("psf", "python software foundation", r"python software foundation licen[cs]e", ("", "2")),
    ("php", "php licen", r"php licen[cs]e", ("", "3.0", "3.01")),
    ("eupl", "european union public", r"european union public licen[cs]e", ("", "1.0", "1.1", "1.2")),
    ("odbl", "open database", r"open database licen[cs]e", ("", "1.0")),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e", ("",)),
    ("osl", "open software licen", r"open software licen[cs]e", ("", "2.1", "3.0")),
    ("cc0", "cc0", r"cc0", ("", "1.0")),
    ("cc-by", "cc by", r"cc by", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "cc by sa", r"cc by sa", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", "cc by nd", r"cc by nd", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", "cc by nc", r"cc by nc", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "creative commons attribution", r"creative commons attribution(?: licen[cs]e)?", ("", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "commons attribution share", r"creative commons attribution share ?alike(?: licen[cs]e)?", ("", "3.0", "4.0")),
    ("cc-by-nc", "commons attribution non", r"creative commons attribution non ?commercial(?: licen[cs]e)?", ("", "3.0", "4.0")),
)

#: (label, keyword, expression): sentences of license texts and notices.
SENTENCES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and (?:or )?distribute this software for any purpose"),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms"),
    ("gpl", "free software you can redistribute", r"free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "free software you can redistribute", r"free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl", "free software you can redistribute", r"free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("apache-2.0", "you may not use this file except", r"you may not use this file except in compliance with the licen[cs]e"),
    ("mpl-2.0", "subject to the terms of the mozilla", r"subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("unlicense", "free and unencumbered", r"free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"in the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("zlib", "provided as is without any express", r"this software is provided as is without any express or implied warranty"),
    ("wtfpl", "do what the fuck", r"do what the fuck you want to public licen[cs]e"),
)

#: Priorities: 4 identifier or license sentence, 3 grant with version, 2 grant or version, 1 bare name.
NOTICE = r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) (?:to you )?(?:under|by|with) (?:the )?(?:terms of )?(?:the )?"

#: One of these literals stands in every text in which a rule can match; none
#: spans words, which any marks and line ends may part.
STEMS = ("licens", "licenc", "gpl", "clause", "wtfpl", "cc0", "commons", "domain", "reserved",
         "permission", "redistribution", "spdx", "unencumbered", "implied", "fuck")
CC_BY = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by"


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, expression, priority, score) of every rule."""
    out = []
    for label, keyword, name, versions in LICENSES:
        for v in versions:
            full = f"{label}-{v}" if v else label
            out.append((full, "spdx", "spdx licen[cs]e identifier " + full.replace("-", " ").replace(".", " "), 4, 1.0))
            if v:
                number = r" ".join(v.split(".")) if v.count(".") and not v.endswith(".0") else v.split(".")[0] + "(?: 0)?"
                named = rf"{name}(?: version| v)? ?{number}(?! \d)"
            else:
                named = name
            out.append((full, keyword, named, 2 if v else 1, 0.9 if v else 0.7))
            out.append((full, keyword, NOTICE + named, 3 if v else 2, 1.0 if v else 0.9))
            if v:
                out.append((f"{full}-or-later", keyword, named + r"(?: of the licen[cs]e)? or (?:at your option )?(?:any )?later(?: version)?", 4, 1.0))
    out += [(label, keyword, expression, 4, 1.0) for label, keyword, expression in SENTENCES]
    return out


def in_words(expression: str) -> str:
    return f"(?<= )({expression})(?= )"


def spans(normal: str, pattern: str) -> str:
    """SQL: (start, stop) words of every match, by marking the matches' ends."""
    return f"""transform(array(split(regexp_replace({normal}, {pattern}, '\u0001$1\u0002'), ' ')), ws ->
      arrays_zip(filter(transform(ws, (w, i) -> if(startswith(w, '\u0001'), i - 1, null)), x -> x is not null),
                 filter(transform(ws, (w, i) -> if(endswith(w, '\u0002'), i, null)), x -> x is not null)))[0]"""


SUPPRESS = """aggregate(array_sort(hits),
  named_struct('e1', -1, 'e2', -1, 'e3', -1, 'e4', -1, 'labels', cast(array() as array<string>), 'score', 0D),
  (a, h) -> if(case h.below when -4 then a.e4 when -3 then a.e3 when -2 then a.e2 else a.e1 end >= -h.back, a,
    named_struct('e1', greatest(a.e1, -h.back),
      'e2', if(h.below <= -2, greatest(a.e2, -h.back), a.e2),
      'e3', if(h.below <= -3, greatest(a.e3, -h.back), a.e3),
      'e4', if(h.below <= -4, greatest(a.e4, -h.back), a.e4),
      'labels', array_union(a.labels, array(h.label)), 'score', greatest(a.score, h.score))))"""


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, base (array of start, label), found (struct of
    labels and score after suppression); both null where no keyword stands.
    Columns of these names, and of the names normal and hits, are replaced."""
    low = F.lower(F.coalesce("text", F.lit("")))
    gate = low.rlike(CC_BY)
    for stem in STEMS:
        gate = low.contains(stem) | gate
    words = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    normal = F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.col("text")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))
    base = [(("gate", f" {p} "), ("pattern", in_words(p)), ("label", b)) for p, b in BASE]
    table = [(("gate", f" {k}"), ("pattern", in_words(e)), ("label", a), ("priority", p), ("score", c)) for a, k, e, p, c in rules()]
    some = F.col("normal").isNotNull()
    return (docs.withColumn("n_words", F.coalesce(F.regexp_count("text", F.lit(words)), F.lit(0)).cast("long"))
            .withColumn("normal", F.when(gate, normal))
            .withColumn("base", F.when(some, flat(base, "contains(normal, r.gate)", "struct(z.`0` as start, r.label as label)")))
            .withColumn("hits", F.when(some, flat(table, "contains(normal, r.gate)",
                                          "struct(z.`0` as start, -z.`1` as back, -r.priority as below, r.label as label, r.score as score)")))
            .withColumn("found", F.expr(f"if(size(hits) > 0, {SUPPRESS}, null)"))
            .drop("normal", "hits"))


def flat(rows: list[tuple], gate: str, row: str) -> Column:
    """All ``row`` of the matches z of those rules r whose gate the text passes."""
    table = "array(" + ", ".join("named_struct(" + ", ".join(f"'{n}', {literal(v)}" for n, v in r) + ")" for r in rows) + ")"
    return F.expr(f"flatten(transform(filter({table}, r -> {gate}), r -> transform({spans('normal', 'r.pattern')}, z -> {row})))")


def literal(value) -> str:
    if isinstance(value, str):
        return "r'" + value + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def op8_licenses(docs: DataFrame) -> DataFrame:
    """The contract's rows: base detections are kept whatever the method says."""
    s = scan(docs.select("doc_id", "text"))
    base_labels = F.array_sort(F.array_distinct(F.coalesce(F.expr("transform(base, b -> b.label)"), F.array().cast("array<string>"))))
    own = F.coalesce(F.col("found.labels"), F.array().cast("array<string>"))
    return s.select(
        "doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.expr("array_min(transform(base, b -> b.start))").cast("long").alias("first_word"),
        F.expr("array_max(transform(base, b -> b.start))").cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        F.greatest(F.coalesce("found.score", F.lit(0.0)), F.when(F.size("base") > 0, 0.7).otherwise(0.0)).alias("score"))
