"""How the sources of a language differ in their words: count-cell ranking.

Terms are runs of letters (ASCII letters and everything beyond ASCII). Each
language keeps the V terms that stand in at least ``LEAST_DOCS`` of its
documents. A term's weight p in a group (a source of a language, or a language)
is 1 + floor(10**9 * (count + 2) / (N + 2V)); two groups differ in a term by
f(p, q) = floor((p - q)**2 / (p + q)).

f depends on the two counts alone. So the terms of a group are counted in
*cells* (group count, language count); f is evaluated once per cell, cells of
equal value are merged, and only the cells that begin within the first ranks,
by cumulative multiplicity, are expanded into terms, in UTF-8 order. For pairs
of sources, terms with the same counts in all sources are one cell as well,
with a multiplicity; sums over cells are formed in blocks of at most
``SOURCES`` x ``SOURCES`` sources inside tasks.

All arithmetic is on integers: products that may pass 64 bits are decimals.

Edge cases: null text, lang and source are the empty string; a group without
terms has p from its counts of 0, and a language that keeps no term has pair
values of 0 and no term rows; the only source of a language has no pair rows;
rows that repeat a doc_id count as documents of their own (ids are not read);
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import ship, shuffle_partitions, store, text_slices

LEAST_DOCS = 10
TOP = 10
#: Sources of a block: a task holds that many squared sums at most.
SOURCES = 512

#: Every byte of UTF-8 to itself, A-Z to a-z, and other ASCII to a blank.
FOLD = np.array([b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)], np.uint8)


def terms_of(texts: pa.Array):
    """(codes, vocabulary, offsets): the terms of every text, as codes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, ends, data = texts.buffers()
    if texts.offset:
        raise ValueError("a whole array is expected")
    folded = FOLD[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    texts = pa.LargeStringArray.from_buffers(len(texts), ends, pa.py_buffer(folded.tobytes()))
    parts = pc.ascii_split_whitespace(texts)
    coded = parts.values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, parts.offsets.to_numpy()


def count_terms(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents. A null term
    stands for a group as such. Counts are summed up inside tasks first."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in text_slices(batches):
            codes, vocab, offsets = terms_of(batch.column("text"))
            groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
            pair_of = {}
            group = np.array([pair_of.setdefault((g["lang"], g["source"]), len(pair_of)) for g in groups.to_pylist()], np.int64)
            pairs = list(pair_of)
            size = max(1, len(vocab))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            real = codes != (vocab.index("").as_py() if len(vocab) else -1)
            codes, row = codes[real], row[real]
            in_row, times = np.unique(row * size + codes, return_counts=True)
            key = group[in_row // size] * size + in_row % size
            keys, at = np.unique(key, return_inverse=True)
            n = np.bincount(at, weights=times, minlength=len(keys)).astype(np.int64)
            in_docs = np.bincount(at, minlength=len(keys)).astype(np.int64)
            g = np.concatenate([keys // size, np.arange(len(pairs))])
            words = pa.chunked_array([vocab.take(pa.array(keys % size)).cast(pa.string()), pa.nulls(len(pairs), pa.string())]).combine_chunks()
            names = [pa.array([p[i] for p in pairs], pa.string()).take(pa.array(g)) for i in (0, 1)]
            zeros = np.zeros(len(pairs), np.int64)
            yield pa.record_batch([*names, words, pa.array(np.concatenate([n, zeros])), pa.array(np.concatenate([in_docs, zeros]))],
                                  names=["lang", "source", "term", "n", "docs"])

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def weight(n, total, kept):
    """p of a count in a group of ``total`` occurrences in a language of ``kept`` terms, exactly; null where none is kept."""
    n, total, kept = (F.expr(x).cast("decimal(20,0)") if isinstance(x, str) else x.cast("decimal(20,0)") for x in (n, total, kept))
    above, below = (n + 2) * F.lit(10**9).cast("decimal(10,0)"), total + kept * 2
    quotient = F.call_function("div", above.cast("decimal(38,0)"), F.nullif(below, F.lit(0)).cast("decimal(38,0)"))
    return F.lit(1).cast("long") + quotient.cast("long")


def salted(df: DataFrame, times: int, *by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(times)).cast("int"))


def for_salts(df: DataFrame, times: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


class Counts:
    """The stored counts that both parts are made of."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        self.salts = shuffle_partitions(docs.sparkSession)
        counted = store(count_terms(docs), "divergence-counts")
        words = counted.where("term is not null")
        in_lang = (words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= least_docs).select("lang", "term", "lang_n"))
        # kept terms of every group in which they occur
        self.words = store(words.select("lang", "source", "term", "n").join(in_lang, ["lang", "term"]), "divergence-words")
        langs = in_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        groups = counted.where("term is null").select("lang", "source")
        totals = self.words.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        # one row per group, with the language's figures and the group's number in it
        groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
        numbered = groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        self.groups = store(numbered, "divergence-groups")


def term_part(counts: Counts, top: int = TOP) -> DataFrame:
    """Each group's first ``top`` terms that it has more of than its language."""
    cells = counts.words.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("multiplicity"))
    # the figures of a group, for the cells of a hot one in many tasks
    valued = (salted(cells, counts.salts, "n", "lang_n").join(for_salts(counts.groups, counts.salts), ["lang", "source", "salt"])
              .withColumn("p", weight("n", "total", "kept")).withColumn("q", weight("lang_n", "lang_total", "kept"))
              .where("p > q").withColumn("value", F.expr("(p - q) * (p - q) div (p + q)")))
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("multiplicity").alias("multiplicity"))
    # values are of one term at least: the first `top` of them are enough
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = merged.withColumn("at", F.row_number().over(w)).where(F.col("at") <= top)
    before = F.coalesce(F.sum("multiplicity").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = first.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    chosen = valued.select("lang", "source", "n", "lang_n", "value").join(first, ["lang", "source", "value"])
    expanded = counts.words.join(chosen, ["lang", "source", "n", "lang_n"])
    w = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (expanded.withColumn("at", F.row_number().over(w)).where(F.col("at") <= top)
            .withColumn("rank", F.col("before") + F.col("at")).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank")))


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every element of a column of lists."""
    return np.repeat(np.arange(len(column)), pc.list_value_length(column).to_numpy()), column.flatten().to_numpy()


def block_sums(batches, size: int):
    """Sums of f over cells, for all pairs of sources of two blocks; one row per
    pair and task. Rows of a (lang, block, block) may stand in several tasks."""
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "i", "j")), strict=True))
        rows_of: dict[tuple, list[int]] = {}
        for row, key in enumerate(keys):
            rows_of.setdefault(key, []).append(row)
        for key, rows in rows_of.items():
            zeros = [np.array(batch.column(f"zeros_{c}")[rows[0]].as_py(), np.int64) for c in "ij"]
            own = sums.setdefault(key, np.zeros((len(zeros[0]), len(zeros[1])), np.int64))
            # as many cells at once as keep a matrix in about 8 MB
            most = max(1, (1 << 20) // max(len(z) for z in zeros))
            for start in range(0, len(rows), most):
                part = batch.take(pa.array(rows[start:start + most]))
                sides = []
                for c, zero in zip("ij", zeros, strict=True):
                    m = np.tile(zero[:, None], (1, part.num_rows))
                    row, at = lists(part.column(f"at_{c}"))
                    m[at, row] = lists(part.column(f"p_{c}"))[1]
                    sides.append(m)
                times = part.column("multiplicity").to_numpy()
                for a, p in enumerate(sides[0]):
                    own[a] += difference(p, sides[1]) @ times
    for (lang, i, j), own in sums.items():
        n = own.shape[1]
        for a in range(len(own)):
            yield pa.record_batch([pa.array([lang] * n, pa.string()), pa.array(np.full(n, i * size + a)),
                                   pa.array(j * size + np.arange(n)), pa.array(own[a])], names=["lang", "a", "b", "value"])


def pair_part(counts: Counts, sources: int = SOURCES) -> DataFrame:
    """Each group against each other source of its language."""
    spark = counts.groups.sparkSession
    groups = counts.groups
    zero = groups.where("kept > 0").withColumn("zero", weight("0L", "total", "kept"))
    # per language and block of sources: the weights of terms that a source lacks, in the order of numbers
    blocks = (zero.groupBy("lang", F.floor(F.col("number") / sources).cast("int").alias("block"))
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "zero"))), lambda x: x["zero"]).alias("zeros")))
    pairs = (blocks.select("lang", F.col("block").alias("i"), F.col("zeros").alias("zeros_i"))
             .join(blocks.select("lang", F.col("block").alias("j"), F.col("zeros").alias("zeros_j")), "lang").where("i <= j"))
    numbered = (salted(counts.words, counts.salts, "term")
                .join(for_salts(groups.select("lang", "source", "number", "total", "kept"), counts.salts), ["lang", "source", "salt"])
                .select("lang", "term", F.col("number"), weight("n", "total", "kept").alias("p")))
    # a term's weights in the sources that have it; terms with the same ones are a cell
    vectors = numbered.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("number", "p"))).alias("weights"))
    cells = store(vectors.groupBy("lang", "weights").agg(F.count("*").alias("multiplicity")), "divergence-cells")

    def part(block: str):
        own = F.filter("weights", lambda w: F.floor(w["number"] / sources) == F.col(block))
        return (F.transform(own, lambda w: w["number"] - F.col(block) * sources).alias(f"at_{block}"),
                F.transform(own, lambda w: w["p"]).alias(f"p_{block}"))

    dealt = (salted(cells, counts.salts, "weights").join(for_salts(pairs, counts.salts), ["lang", "salt"])
             .select("lang", "i", "j", "zeros_i", "zeros_j", *part("i"), *part("j"), "multiplicity"))
    sums = (dealt.mapInArrow(lambda batches: block_sums(batches, sources), "lang string, a long, b long, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).where("a < b"))
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    # every pair of sources of a language, also where no term is kept
    names = groups.select("lang", F.col("number").alias("a"), "source")
    others = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    rows = (names.join(others, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
            .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(w))


def op12_divergence(docs: DataFrame, sources: int = SOURCES) -> DataFrame:
    """The contract's rows."""
    counts = Counts(docs)
    return pair_part(counts, sources).unionByName(term_part(counts))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT nr, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT nr) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
counted AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL),
weights AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.lang_n + 2) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN totals t USING (lang, source)
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM weights a JOIN weights b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM weights WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""
