"""Near-duplicate detection with MinHash bands and odd sketches.

A text is the set of its word shingles. Texts with equal sets form a class, and
one row per class goes on. Bands of MinHash values propose pairs of classes; an
odd sketch of each class (the MinHash values hashed into a bitmap of parities)
estimates from the weight of an XOR how similar two are, and pairs far below
the threshold are dropped; the rest is confirmed on the full sets. Confirmed
links are joined into components.

Aggregates that are joined back are stored first, so that the join is one of two
plain shuffles and a key with many rows can be split at run time.

No bucket is expanded into all its pairs. Each member of a bucket is compared
with the bucket's smallest class, its centre, which settles most groups of near
copies; the comparison keeps the member's set as its difference from the
centre's. Then members of one centre whose components still differ are compared
in blocks, inside the tasks: sketches first, then a bound from what both share
with the centre, then exactly. Only links leave a block. So every pair that
shares a band is compared, dropped by its sketches, or already linked.

At the defaults a pair at a similarity of 0.85 shares no band with probability
4e-7, and its sketches fall below the filter with 1e-6 (the XOR weight spreads by
6.5 bits; the filter stands 4.7 times that above the expected weight).

Edge cases: a null, empty or blank text has no shingles, is linked with nothing
and is its own component; a text with fewer words than a shingle is one
shingle; rows that repeat a doc_id are separate texts that share the id; a
component's id is its smallest doc_id that is not null; an empty table gives an
empty result; further columns are ignored by :func:`near_duplicates` and kept
by :func:`drop_near_duplicates`.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from stratus.llm.common import Words, components, mix64, shuffle_partitions, signed, store, text_slices, window_hashes

BANDS, ROWS = 25, 5
SKETCH_BITS = 256
#: Members of a star that one task compares with its centre, about.
STAR_PART = 200
#: Members of an open star in a block: an eighth of the star, within these.
BLOCK_LEAST, BLOCK_MOST = 128, 1024

CHUNK = 1 << 16  # shingles that are hashed at once, for the cache


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all texts in a row, sorted within a text; where each text begins)."""
    h, offsets = words.hashes(), words.offsets
    size = np.diff(offsets)
    count = np.where(size >= k, size - k + 1, size > 0)
    at = np.concatenate([[0], np.cumsum(count)])
    runs = np.empty(at[-1], np.uint64)
    runs[np.repeat(size >= k, count)] = window_hashes(h, offsets, k)[0]
    for d in np.flatnonzero((size > 0) & (size < k)):  # the whole sequence is the one shingle
        own = h[offsets[d]:offsets[d + 1]]
        runs[at[d]] = window_hashes(own, np.array([0, len(own)]), len(own))[0][0] ^ np.uint64(size[d])
    new = np.ones(len(runs), bool)
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        runs[lo:hi].sort()
    new[1:] = runs[1:] != runs[:-1]
    new[at[:-1][count > 0]] = True
    return runs[new], np.concatenate([[0], np.cumsum(new)])[at]


def set_keys(sets: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """16 bytes that identify each set; None for an empty one."""
    some = np.flatnonzero(np.diff(at))
    out = [None] * (len(at) - 1)
    if len(some):
        starts = at[:-1][some]
        sums = [np.add.reduceat(mix64(sets ^ np.uint64(salt)), starts) for salt in (0, 0xA5A5A5A5A5A5A5A5)]
        raw = np.stack(sums, axis=1).astype(">u8").tobytes()
        for j, d in enumerate(some):
            out[d] = raw[16 * j:16 * j + 16]
    return out


def signatures(sets: np.ndarray, at: np.ndarray, bands: int, rows: int):
    """MinHash values (texts, bands * rows) of non-empty sets."""
    k = bands * rows
    rng = np.random.default_rng(0x5EED)
    flip = rng.integers(0, 2**64, k, np.uint64)
    factor = rng.integers(0, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(at) - 1
    out = np.empty((n, k), np.uint64)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK, side="right")) - 1)
        x, starts = sets[at[lo]:at[hi]], at[lo:hi] - at[lo]
        for i in range(k):
            out[lo:hi, i] = np.minimum.reduceat((x ^ flip[i]) * factor[i], starts)
        lo = hi
    return out


def odd_sketches(values: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps (texts, bits / 64) of the MinHash values."""
    n, k = values.shape
    place = mix64(values + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)
    flat = (np.arange(n)[:, None] * bits + place.astype(np.int64)).ravel()
    odd = (np.bincount(flat, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1).view(np.uint64)


def most_bits(similarity: float, bits: int, k: int) -> int:
    """XOR weight that sketches of that similarity are expected to have.

    k (1 - similarity) MinHash values differ, and each puts one value of either
    text into the parities: 2 k (1 - similarity) throws into ``bits`` cells.
    """
    return math.floor(bits / 2 * (1 - math.exp(-4 * k * (1 - similarity) / bits)))


def describe(docs: DataFrame, k: int, bands: int, rows: int, bits: int) -> DataFrame:
    """(doc_id, n_shingles, cls, bands, s0..) per row; cls identifies the set, null if empty."""
    words_n = bits // 64

    def run(batches):
        for batch in text_slices(batches):
            sets, at = shingle_sets(Words(batch.column("text")), k)
            n = np.diff(at)
            some = np.flatnonzero(n)
            band_rows, sketch = [None] * len(n), np.zeros((len(n), words_n), np.int64)
            if len(some):
                values = signatures(sets, np.append(at[:-1][some], len(sets)), bands, rows)
                keys = np.zeros((len(some), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    keys = mix64(keys ^ values[:, r::rows])
                sketch[some] = signed(odd_sketches(values, bits))
                for d, own in zip(some, signed(keys), strict=True):
                    band_rows[d] = own
            yield pa.record_batch([batch.column("doc_id"), pa.array(n), pa.array(set_keys(sets, at), pa.binary()), pa.array(band_rows, pa.list_(pa.int64()))]
                                  + [pa.array(sketch[:, i]) for i in range(words_n)],
                                  names=["doc_id", "n_shingles", "cls", "bands"] + [f"s{i}" for i in range(words_n)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, cls binary, bands array<long>, " + ", ".join(f"s{i} long" for i in range(words_n)))


def compare(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Each pair (centre, member) on its full sets: whether it is a link, and
    the member's set as bits over the centre's sorted shingles and the rest of
    its hashes (both null for the only member of a centre).

    Members meet their centre in parts of about STAR_PART, each with a copy of
    the centre's text, so a centre of many members is split over tasks.
    """
    spark = pairs.sparkSession
    parts = store(pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR_PART).cast("int").alias("parts"), (F.count("*") == 1).alias("alone")), "parts")
    members = (pairs.join(parts, "centre").withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
               .join(texts.withColumnRenamed("cls", "member"), "member")
               .select("centre", "part", F.lit(1).alias("side"), "alone", "member", "text"))
    centres = (parts.join(texts.withColumnRenamed("cls", "centre"), "centre")
               .select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"),
                       "alone", F.col("centre").alias("member"), "text"))

    def run(batches):
        now, own = None, None
        for batch in text_slices(batches):
            sets, at = shingle_sets(Words(batch.column("text")), k)
            rows = []
            for i, (centre, part, side, alone, member) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("centre", "part", "side", "alone", "member")), strict=True)):
                x = sets[at[i]:at[i + 1]]
                if side == 0:
                    now, own = (centre, part), x
                    continue
                if now != (centre, part):
                    raise ValueError("a centre's text is missing")
                common = np.isin(own, x, assume_unique=True)
                both = int(common.sum())
                linked = 100 * both >= percent * (len(own) + len(x) - both)
                bits, rest = (None, None) if alone else (np.packbits(common).tobytes(), np.setdiff1d(x, own, assume_unique=True).tobytes())
                rows.append((centre, member, linked, len(x), bits, rest))
            if rows:
                types = [pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["centre", "member", "linked", "n", "bits", "rest"])

    return (members.union(centres).repartition(shuffle_partitions(spark), "centre", "part")
            .sortWithinPartitions("centre", "part", "side").mapInArrow(run, "centre binary, member binary, linked boolean, n long, bits binary, rest binary"))


def links_in_block(left: list[dict], right: list[dict] | None, percent: int, weight: int):
    """Links (a, b) between members of two blocks of one centre (of one block, if
    ``right`` is None) that are in different components: as many as join them.
    A pair whose components a link of this block has joined is not looked at."""
    rows = left + (right or [])
    root = np.unique([r["root"] for r in rows], return_inverse=True)[1]
    n = np.array([r["n"] for r in rows])
    bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1)
    shared = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    rest = n - shared
    sketch = np.array([r["sketch"] for r in rows], np.int64).view(np.uint64)
    first = len(left) if right is not None else len(rows)
    # one side of a pair from different components is outside the largest
    most, now = np.bincount(root).argmax(), root.copy()
    for i in np.flatnonzero(root != most):
        if right is None:
            at = np.arange(len(rows))
        else:
            at = np.arange(first, len(rows)) if i < first else np.arange(first)
        at = at[(now[at] != now[i]) & ((root[at] == most) | (at > i))]
        at = at[np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1) <= weight]
        both = np.bitwise_count(bits[at] & bits[i]).sum(axis=1).astype(np.int64)
        top = both + np.minimum(rest[at], rest[i])  # at most so many shingles in common
        able = 100 * top >= percent * (n[at] + n[i] - top)
        for j, b in zip(at[able], both[able], strict=True):
            if now[j] == now[i]:
                continue
            b += len(np.intersect1d(np.frombuffer(rows[i]["rest"], np.uint64), np.frombuffer(rows[j]["rest"], np.uint64), assume_unique=True))
            if 100 * b >= percent * (n[i] + n[j] - b):
                yield rows[i]["member"], rows[j]["member"]
                now[now == now[j]] = now[i]


def open_links(compared: DataFrame, roots: DataFrame, meta: DataFrame, words_n: int, percent: int, weight: int) -> DataFrame:
    """Links between members of one centre whose components differ.

    A centre's members are dealt into blocks, and each pair of blocks meets in
    one group; so a group is bounded, and a centre of many members is split.
    """
    spark = compared.sparkSession
    placed = (compared.where("bits is not null").alias("m").join(roots.alias("r"), F.col("m.member") == F.col("r.node"), "left")
              .select("centre", "member", "n", "bits", "rest", F.coalesce("root", "member").alias("root")))
    stars = store(placed.groupBy("centre").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
             .select("centre", F.ceil(F.col("size") / F.least(F.lit(BLOCK_MOST), F.greatest(F.lit(BLOCK_LEAST), F.col("size") / 8))).cast("int").alias("blocks")), "stars")
    sketch = meta.select(F.col("cls").alias("member"), F.array(*(f"s{i}" for i in range(words_n))).alias("sketch"))
    rows = (placed.join(stars, "centre").join(sketch, "member")
            .withColumn("own", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("centre", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "member", "n", "bits", "rest", "root", "sketch"))

    def run(batches):
        now, group = None, []

        def links():
            if not group:
                return
            left = [r for r in group if r["own"] == now[1]]
            right = [r for r in group if r["own"] != now[1]] if now[1] != now[2] else None
            if right is None or (left and right):
                found = list(links_in_block(left, right, percent, weight))
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["centre"], r["lo"], r["hi"])
                if key != now:
                    yield from links()
                    now, group = key, []
                group.append(r)
        yield from links()

    return (rows.repartition(shuffle_partitions(spark), "centre", "lo", "hi").sortWithinPartitions("centre", "lo", "hi", "member")
            .mapInArrow(run, "a binary, b binary"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; options as
    in :func:`mark`."""
    return mark(docs, **options).select("doc_id", "n_shingles", "component_id", "kept")


def mark(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
         bits: int = SKETCH_BITS, slack: float = 0.2) -> DataFrame:
    """:func:`near_duplicates` with each row's class and one class of its
    component as ``root`` (null for texts without shingles). Texts are linked
    when 100 * intersection >= percent * union of their k-word shingles."""
    words_n = bits // 64
    sketch = [f"s{i}" for i in range(words_n)]
    weight = most_bits(percent / 100 - slack, bits, bands * rows)
    described = store(describe(docs, k, bands, rows, bits), "described")
    classes = store(described.where("cls is not null").groupBy("cls")
                    .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), *(F.first(s).alias(s) for s in sketch)), "classes")
    # only the classes that share a band with another one have candidates
    banded = classes.select("cls", F.explode("bands").alias("band"))
    shared = store(banded.groupBy("band").agg(F.min("cls").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n"), "shared")
    members = store(banded.join(shared, "band").select("cls", "centre").distinct(), "members")  # with each centre as its own member
    meta = store(classes.join(members.select("cls").distinct(), "cls", "left_semi").drop("bands"), "classes")

    found = meta.select("cls", F.col("doc_id").alias("found_id"))
    own = F.col("text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("text")).join(found, F.col("doc_id").eqNullSafe(F.col("found_id")))
    texts = store(texts.select("cls", "text").transform(lambda d: only_own(d, k)), "texts")

    stars = members.where("cls <> centre").select("centre", F.col("cls").alias("member"))
    compared = store(compare(stars, texts, k, percent), "compared")
    links = compared.where("linked").select(F.col("centre").alias("a"), F.col("member").alias("b"))
    roots = components(links)
    more = store(open_links(compared, roots, meta, words_n, percent, weight), "links")
    final = roots if more.isEmpty() else components(links.union(more))

    # a component's id is its smallest doc_id; classes without a link are their own component
    tops = (final.alias("f").join(meta.select("cls", "doc_id").alias("c"), F.col("f.node") == F.col("c.cls"))
            .select("node", "root", "doc_id"))
    ids = tops.groupBy("root").agg(F.min("doc_id").alias("top"))
    tops = tops.join(ids, "root").select(F.col("node").alias("cls"), "root", "top")
    tops = (classes.select("cls", "doc_id").join(tops, "cls", "left")
            .select(F.col("cls").alias("t_cls"), F.coalesce("root", "cls").alias("root"), F.coalesce("top", "doc_id").alias("top")))
    tops = store(tops, "tops")  # a join of two plain shuffles: a class of many copies can then be split
    return (described.join(tops, F.col("cls") == F.col("t_cls"), "left")
            .withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("top")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "cls", "root"))


def only_own(texts: DataFrame, k: int) -> DataFrame:
    """Of rows (cls, text) those whose text has that set (others share the id only)."""
    def run(batches):
        for batch in text_slices(batches):
            sets, at = shingle_sets(Words(batch.column("text")), k)
            keep = [a == b for a, b in zip(set_keys(sets, at), batch.column("cls").to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return texts.mapInArrow(run, "cls binary, text string").dropDuplicates(["cls"])


def op3_neardup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, k=3, percent=85)


def with_class(docs: DataFrame, k: int) -> DataFrame:
    """``docs`` with the class of each text as ``__cls``."""
    def run(batches):
        for batch in text_slices(batches):
            sets, at = shingle_sets(Words(batch.column("text")), k)
            yield pa.record_batch([*batch.columns, pa.array(set_keys(sets, at), pa.binary())], names=[*batch.schema.names, "__cls"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__cls", BinaryType())]))


def drop_near_duplicates(docs: DataFrame, k: int = 5, **options) -> DataFrame:
    """One row of ``docs`` per component, in all its columns: that of the smallest
    doc_id and, of rows that repeat it, the smallest text. Texts without
    shingles stay, but for repeated rows."""
    marked = store(mark(docs, k=k, **options).select("doc_id", "cls", "root", "kept"), "marked")
    # ids that do not simply stay: far fewer than those that do, so that the texts stay where they are for longer
    ids = store(marked.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n"), F.max("kept").alias("__any")).where("__n > 1 or not __any"), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    out = docs.join(ids, same, "left_anti")
    repeated = ids.where("__any")
    if repeated.isEmpty():
        return out
    # an id on several rows: their classes tell which of them stay
    rows = with_class(docs.join(repeated, same, "left_semi"), k)
    stay = marked.where("kept").select(F.col("doc_id").alias("__id"), F.col("cls").alias("__own"), F.col("root").alias("__root")).distinct()
    rows = rows.join(stay, same & F.col("__cls").eqNullSafe(F.col("__own")))
    first = Window.partitionBy("doc_id", "__root", F.when(F.col("__root").isNull(), F.col("text"))).orderBy("text")
    return out.union(rows.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").select(*docs.columns))


#: The same rows by comparing every pair of documents that shares a shingle.
ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.top AS component_id, d.doc_id = c.top AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS top FROM r GROUP BY doc_id) c USING (doc_id)
"""
