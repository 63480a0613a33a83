"""Approximate nearest neighbours on shifted space-filling curves.

Vectors are projected to a few random orthogonal directions, shifted, and
ordered along a Hilbert curve; several projections and shifts give several
orderings. Each ordering is range-partitioned and ranked in Spark. A query
looks at the window of ranks around its own place in every ordering; the
windows' candidates are scored by their exact inner product, merged and ranked.

``window`` is the share of all rows in one window. Vectors without cluster or
low-dimensional structure leave a curve little to go by, and only wide windows
reach a recall of 0.9 on them; structured ones need far less. The work is
queries x window x curves, in blocks of bounded size.

Edge cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, nor do null ids; equal keys are
ordered by id, so many copies of one vector spread over blocks; rows that repeat
a vec_id count as one candidate with its best score, and are no candidates of a
query of that id; a query gets fewer than k rows if there are fewer candidates;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import shuffle_partitions, store

CURVES, DIMS, BITS = 8, 8, 8
WINDOW = 0.2
#: Rows of a window at least.
LEAST_ROWS = 512
#: Rows of a block at most, and blocks that a window is made of.
BLOCK_ROWS, BLOCKS = 4096, 3
#: Vectors that the projections' ranges are taken from, about (chosen by a hash of the id).
RANGE_SAMPLE = 4096

OUT = "query_id long, vec_id long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (n, dims) along the Hilbert curve of that many bits
    per axis, by Skilling's transposition (dims * bits <= 64)."""
    x = cells.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(dims):
            bit = (x[i] & q) != 0
            swap = np.where(bit, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(bit, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        flip ^= np.where((x[dims - 1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


class Curves:
    """Random projections, with shifts, and their ranges on a sample."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, seed: int):
        rng = np.random.default_rng(seed)
        width = sample.shape[1]
        self.dims = min(dims, width)
        self.maps = [np.linalg.qr(rng.normal(size=(width, width)))[0][:, :self.dims] for _ in range(curves)]
        self.shifts = rng.random((curves, self.dims))
        self.low = [np.quantile(sample @ m, 0.001, axis=0) for m in self.maps]
        self.high = [np.quantile(sample @ m, 0.999, axis=0) for m in self.maps]

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        y = (vectors @ self.maps[curve] - self.low[curve]) / np.maximum(self.high[curve] - self.low[curve], 1e-12)
        y = np.clip(y, 0, 1) / 2 + self.shifts[curve] / 2
        return hilbert_keys(np.minimum(y * 2 ** BITS, 2 ** BITS - 1).astype(np.uint64), BITS)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of vectors that take part, and their length."""
    v = F.col(vector_col).cast("array<double>")
    real = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id is not null and v is not null and size(v) > 0").where(real).where(F.exists("v", lambda x: x != 0)))
    sizes = some.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = sizes[0].n if sizes else 0
    return some.where(F.size("v") == width), width


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def ranked(vectors: DataFrame, curves: Curves, width: int, n_curves: int) -> DataFrame:
    """(curve, place, vec_id, n): each vector's rank from 0 in every ordering."""
    def run(batches):
        for batch in batches:
            v, ids = matrix(batch.column("v"), width), batch.column("vec_id")
            for c in range(n_curves):
                key = curves.keys(v, c) ^ np.uint64(1 << 63)  # ordered as signed
                yield pa.record_batch([pa.array(np.full(len(v), c, np.int32)), pa.array(key.view(np.int64)), ids], names=["curve", "key", "vec_id"])

    keyed = vectors.mapInArrow(run, "curve int, key long, vec_id long")
    # the id holds the partition above its 33 lowest bits and the row within it below
    order = store(keyed.repartitionByRange(shuffle_partitions(vectors.sparkSession), "curve", "key", "vec_id")
                  .sortWithinPartitions("curve", "key", "vec_id").withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftright("at", 33)
    parts = order.groupBy(part.alias("part"), "curve").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    w = Window.partitionBy("curve").orderBy("part")
    parts = parts.select("part", "curve", "first", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("curve")).alias("n"))
    return (order.withColumn("part", part).join(parts, ["part", "curve"])
            .select("curve", (F.col("before") + F.col("at") - F.col("first")).alias("place"), "vec_id", "n"))


def neighbours(vectors: DataFrame, is_query, k: int = 20, curves: int = CURVES, dims: int = DIMS, window: float = WINDOW,
               id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found by inner
    product, nearest first, ties to the smaller id. ``is_query`` is a condition
    on ``vec_id``."""
    spark = vectors.sparkSession
    some, width = usable(vectors, id_col, vector_col)
    some = store(some, "vectors")
    total = some.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = some.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < max(1.0, 1_000_000 * RANGE_SAMPLE / total))
    sample = sample.select("v").toArrow()["v"].combine_chunks()  # about RANGE_SAMPLE vectors
    sample = matrix(sample, width) if len(sample) else matrix(some.select("v").limit(1).toArrow()["v"].combine_chunks(), width)
    placed = ranked(some, Curves(sample, curves, dims, seed), width, curves)

    rows = min(total, max(LEAST_ROWS, k + 1, math.ceil(window * total)))
    block = max(1, min(BLOCK_ROWS, math.ceil(rows / BLOCKS)))
    members = placed.join(some, "vec_id")
    lo = F.greatest(F.lit(0), F.least(F.col("place") - rows // 2, F.col("n") - rows))
    hi = F.least(F.col("n") - 1, lo + rows - 1)
    at = F.explode(F.sequence(F.floor(lo / block), F.floor(hi / block))).alias("block")
    blocks = members.select("curve", F.floor(F.col("place") / block).alias("block"), F.lit(0).alias("side"), "vec_id", "v")
    queries = members.where(is_query).select("curve", at, F.lit(1).alias("side"), "vec_id", "v")

    def run(batches):
        now, parts, ids, block_rows = None, [], [], None
        for batch in batches:
            curve, blk, side = (batch.column(c).to_numpy() for c in ("curve", "block", "side"))
            v, vec = matrix(batch.column("v"), width), batch.column("vec_id").to_numpy()
            cut = np.flatnonzero((np.diff(curve) != 0) | (np.diff(blk) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(vec)]]), strict=True):
                key = (curve[a], blk[a])
                if key != now:
                    now, parts, ids, block_rows = key, [], [], None
                if side[a] == 0:
                    parts.append(v[a:b])
                    ids.append(vec[a:b])
                    continue
                if block_rows is None:
                    block_rows = (np.concatenate(parts), np.concatenate(ids))
                for i in range(a, b, 256):
                    yield from best(v[i:min(b, i + 256)], vec[i:min(b, i + 256)], *block_rows, k)

    found = (blocks.union(queries).repartition(shuffle_partitions(spark), "curve", "block").sortWithinPartitions("curve", "block", "side", "vec_id")
             .mapInArrow(run, OUT).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """The k best rows of a block for each query; scores are summed alike for
    every pair, so equal vectors tie exactly."""
    near = queries @ rows.T
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    out_q, out_v, out_s = [], [], []
    take = min(k, len(ids))
    bar = np.partition(near, len(ids) - take, axis=1)[:, len(ids) - take]
    for i, q in enumerate(query_ids):
        at = np.flatnonzero(near[i] >= bar[i] - 1e-9) if np.isfinite(bar[i]) else np.flatnonzero(np.isfinite(near[i]))
        if not len(at):
            continue
        score = (rows[at] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[at], -score))[:k]
        out_q.append(np.full(len(order), q))
        out_v.append(ids[at][order])
        out_s.append(score[order])
    if out_q:
        yield pa.record_batch([pa.array(np.concatenate(x)) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"])


def op1_ann(vectors: DataFrame) -> DataFrame:
    return neighbours(vectors, F.col("vec_id") % 20 == 0)
