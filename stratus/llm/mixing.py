"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order (order of a keyed
digest of the id), repeated for at most ``max_epochs`` passes. A document's
virtual finish time is the words its source has sent up to and including it,
divided by the source's weight. Sorting all copies by finish time and stopping
when the budget is spent gives every unexhausted source words in proportion to
its weight; a source that has sent all its passes leaves the rest to others.
The copy in service at the cut is truncated there.

Edge cases: a null text has size 0 and is never taken; null is a source of its
own, sorted last; rows that repeat a doc_id are separate documents with the
same place in the shuffle (ties broken by size); an empty table gives an empty
result; further columns are ignored by :func:`mix` and kept by :func:`apply_mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import WORD, store

#: Rows that one window of the queue order holds, about; and most slices of a source.
ROWS_PER_SLICE, MAX_SLICES = 250, 65536

#: The weights of the contract, repeating over the sources in code point order.
CYCLE = (5, 2, 1)


def words(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, cycle=CYCLE) -> DataFrame:
    """Weights repeating ``cycle`` over the sources by code point, null last.
    One row per source, so one ordered window over them is small."""
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (n % len(cycle) + 1).cast("int")).cast("double"))


def targets(sources: DataFrame, budget: float, max_epochs: int) -> DataFrame:
    """Water filling: (source, source_size, weight) -> with ``target``.

    Fair queueing serves ``min(weight * v, cap)`` words of a source up to the
    virtual time v. The served total is concave and piecewise linear in v, so
    the time at which the budget is spent is the largest solution over the
    prefixes of sources ordered by the time at which each is exhausted.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    w = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    all_size = F.sum("source_size").over(whole).cast("double")
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(w), F.lit(0.0))
    at = (all_size * F.lit(float(budget)) - F.coalesce(F.sum(cap).over(w), F.lit(0.0))) / rest
    return (sources.withColumn("at", at)
            .withColumn("cut", F.max("at").over(whole))
            .select("source", "source_size", "weight", F.least(F.col("weight") * F.col("cut"), cap).alias("target")))


def mix(docs: DataFrame, weights=cycle_weights, budget: float = 1.5, max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, finish) per document.

    ``taken`` counts the words the mix takes of the document, over all passes;
    ``finish`` is the virtual finish time of its first copy. ``weights`` maps
    (source, source_size) to rows with a ``weight``. Sizes are pre-aggregated
    per source and slice of the shuffle, so no source is ever in one task: a
    document's place in its queue is its slice's start plus its place within.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = store(docs.select("doc_id", "source", words(F.col("text")).alias("size"), key.alias("key")), "sized")
    slices = max(1, min(MAX_SLICES, -(-sized.count() // ROWS_PER_SLICE)))
    at = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * slices / 2**32).cast("int")
    sized = sized.withColumn("slice", at)

    by_slice = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    totals = by_slice.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    plan = targets(weights(totals), budget, max_epochs)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_slice.withColumn("before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    # one row per source and slice, with all that its documents need
    starts = (starts.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
              .select(F.col("s.source").alias("q_source"), F.col("slice").alias("q_slice"), "before", "source_size", "weight", "target"))

    within = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    queue = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    queue = queue.join(starts, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("slice") == F.col("q_slice")))
    start = F.col("before") + F.col("inside")
    cut = F.round("target").cast("long")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), cut - F.lit(e) * F.col("source_size") - start)) for e in range(1, max_epochs)),
                F.greatest(F.lit(0), F.least(F.col("size"), cut - start)))
    return queue.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                        ((start + F.col("size")) / F.col("weight")).alias("finish"), "key")


def op7_mix(docs: DataFrame) -> DataFrame:
    """The contract's rows in the order of the mix: a global range sort by the
    finish time of each document's first copy."""
    return (mix(docs).select("doc_id", "size", "source_size", "target", "taken", "finish")
            .orderBy("finish", "doc_id"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix sends, in all their columns: a document
    comes once per pass of which at least half its words are taken."""
    chosen = (mix(docs, **options).where("size > 0")
              .withColumn("copies", F.floor((F.col("taken") + F.col("size") / 2) / F.col("size")).cast("int"))
              .where("copies > 0")
              .groupBy(F.col("doc_id").alias("__mix_id"), F.col("size").alias("__mix_size")).agg(F.max("copies").alias("__mix_copies")))
    return (docs.withColumn("__mix_own", words(F.col("text")))
            .join(chosen, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_own") == F.col("__mix_size")))
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
            .select(*docs.columns))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sources),
cuts AS (
  SELECT max(((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE - before_cap) / (all_weight - before_weight)) AS cut
  FROM (SELECT coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0) AS before_cap,
               coalesce(sum(weight) OVER w, 0) AS before_weight, sum(weight) OVER () AS all_weight
        FROM weighted
        WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
plan AS (SELECT source, source_size, weight, least(weight * cut, 2.0::DOUBLE * source_size) AS target FROM weighted, cuts),
queue AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.weight,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, round(target)::BIGINT - start))
        + greatest(0, least(size, round(target)::BIGINT - source_size - start)))::BIGINT AS taken,
       (start + size) / weight AS finish
FROM queue
"""
