"""Substring dedup by collinear chaining of shared word seeds.

Every text gives seeds: of each ``WINDOW`` consecutive runs of k words the one
with the smallest hash, so texts that share ``WINDOW + k - 1`` words in a row
share a seed at the same place; and likewise long seeds, so that any ``PIECE``
words in a row have one. A seed's first document (the smallest doc_id that has
it) is its origin; every other occurrence is matched with the origin and with the
last document before its own, however many documents share the seed: short runs
that also stand in other texts hide no longer passage. The matches of a pair are
chained: the best-scoring ordered subset under gap costs, found with a Fenwick
tree over the origin's positions. Chains, of one seed too, are then aligned word
by word and drawn out over unequal words as far as they hold up; only then must
they have the length of a piece. The pieces of a text that an earlier document
has are joined into passages.

Edge cases: null, empty and blank texts have no words and no passages; a text
with fewer than k words has no seeds; a null doc_id comes before all others;
rows that repeat a doc_id count as one document, never as each other's origin,
and a passage is reported when any of them has it; an empty table gives an empty
result; further columns are ignored by :func:`passages` and kept by
:func:`cut_passages`. A document's chains are bounded by its length. The longest
gap that a chain bridges is where gap costs outweigh a seed's score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import Words, mix64, ship, shuffle_partitions, store, text_slices, window_hashes

K, WINDOW = 5, 8
#: Runs of k words that a long seed has. Any PIECE words in a row have a long seed.
LONG = 3
#: Words that a passage has at least, and a piece of one; share of its words that are equal.
LEAST, PIECE, SAME = 50, 25, 0.8
#: Score of a seed; cost of each word that a chain advances, mean of both sides.
SEED_SCORE, GAP_COST = 5.0, 0.2
#: Words between seeds beyond which chaining them never pays.
REACH = int(SEED_SCORE / GAP_COST)
#: Words that chains are looked at beyond their ends, and that the sides may shift there; spaces between pieces of one passage.
MARGIN, SHIFT, JOIN = 28, 6, 3
#: Slices of one text that one task answers, about; a text that more are asked of goes to several.
REQUESTS = 4096
#: Words of slices that a task hands on at once, about; slices that are sorted at once, and aligned at once.
ANSWER_WORDS, BUCKET_SLICES, ALIGNED_SLICES = 4 << 20, 1 << 17, 1 << 14
#: Documents whose seeds give the ranges that all seeds are dealt by, at least.
RANGE_SAMPLE = 4096
#: Seeds that a range has, about: so many are sorted at once.
RANGE_SEEDS = 1 << 20

FIRST = -2**63  # stands for a null doc_id


def chosen_of(rank: np.ndarray, count: np.ndarray, ends: np.ndarray, of: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest rank of each ``window`` consecutive runs of a text."""
    chosen = [np.zeros(0, np.int64)]
    if len(rank) >= window:
        best = np.lib.stride_tricks.sliding_window_view(rank, window).argmin(axis=1) + np.arange(len(rank) - window + 1)
        chosen.append(best[np.arange(len(best)) + window <= ends[of[:len(best)]]])
    for d in np.flatnonzero((count > 0) & (count < window)):
        lo = ends[d] - count[d]
        chosen.append(np.array([lo + rank[lo:ends[d]].argmin()]))
    return np.unique(np.concatenate(chosen))


def ranges_of(docs: DataFrame, k: int, window: int, n: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """Points (seed, doc) that part all seeds in about equal ranges, ``parts`` for
    each of n tasks and of about RANGE_SEEDS seeds at most, and ``parts``. They
    come from the seeds of about RANGE_SAMPLE documents, or 16 for a task; a seed
    that many documents share may hold several. The texts of all others are not
    cut for it."""
    ship(docs.sparkSession)
    share = min(1.0, max(RANGE_SAMPLE, 16 * n) / max(1, docs.count()))
    some, kept = docs, 1
    if share < 1:
        some, kept = docs.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < share * 1_000_000), 16
    rows = some.mapInArrow(seeds_in(k, window, kept), SEED).toArrow()
    parts = max(1, -int(-len(rows) * kept / share // (n * RANGE_SEEDS)))
    seed, doc = rows["seed"].to_numpy(), rows["doc"].to_numpy()
    order = np.lexsort((doc, seed))
    at = order[(np.arange(1, n * parts) * len(order)) // (n * parts)] if len(order) else order
    return (seed[at], doc[at]), parts


def range_of(seed: np.ndarray, doc: np.ndarray, ranges: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many points of ``ranges`` come before each (seed, doc)."""
    seeds, docs = ranges
    low, high = np.searchsorted(seeds, seed, side="left"), np.searchsorted(seeds, seed, side="right")
    out = low.copy()
    tied = np.flatnonzero(low < high)
    for a in np.unique(low[tied]):
        rows = tied[low[tied] == a]
        out[rows] = a + np.searchsorted(docs[a:high[rows[0]]], doc[rows], side="left")
    return out


SEED = "seed long, doc long, pos int"
BLOCK = "range int, n int, held binary"


def seeds_in_slice(batch: pa.RecordBatch, k: int, window: int):
    """Arrays (seed, doc, pos) of a batch of texts, by text and place; pos is
    -1 - pos where the text has the seed before. Seeds have 56 bits: two
    unequal runs meet seldom, and are told apart when their chain is aligned. Odd
    seeds stand for runs of LONG * k words, even ones for runs of k."""
    words = Words(batch.column("text"))
    hashes, first = window_hashes(words.hashes(), words.offsets, k)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    doc = np.searchsorted(words.offsets, first, side="right") - 1
    count = np.bincount(doc, minlength=batch.num_rows)
    at = chosen_of(mix64(hashes ^ np.uint64(0x51ED2701)), count, np.cumsum(count), doc, window)
    seed = (hashes[at] >> np.uint64(8)) & ~np.uint64(1)
    begins = np.flatnonzero(np.arange(len(hashes)) + (LONG - 1) * k < np.cumsum(count)[doc])
    if len(begins):
        runs = np.zeros(len(begins), np.uint64)
        for i in range(LONG):
            runs = mix64(runs ^ hashes[begins + i * k]) + np.uint64(0x9E3779B97F4A7C15)
        count = np.maximum(count - (LONG - 1) * k, 0)
        far = chosen_of(mix64(runs ^ np.uint64(0x51ED2701)), count, np.cumsum(count), doc[begins], max(1, PIECE - LONG * k + 1))
        at, seed = np.concatenate([at, begins[far]]), np.concatenate([seed, (runs[far] >> np.uint64(8)) | np.uint64(1)])
    order = np.argsort(at, kind="stable")
    at, seed = at[order], seed[order]
    of, pos = doc[at], first[at] - words.offsets[doc[at]]
    # by text and seed, and, as places ascend, by place: one stable sort of a mixed key
    order = np.argsort(seed ^ mix64(of.astype(np.uint64) + np.uint64(1)), kind="stable")
    again = np.zeros(len(at), bool)
    again[order[1:]] = (seed[order[1:]] == seed[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    return seed.view(np.int64), batch.column("doc").to_numpy()[of], np.where(again, -1 - pos, pos).astype(np.int32)


def seeds_in(k: int, window: int, share: int = 1):
    """Rows SEED of texts; of each 16 or so (``share``) places one."""
    def run(batches):
        for batch in text_slices(batches):
            seed, doc, pos = seeds_in_slice(batch, k, window)
            kept = mix64(seed.view(np.uint64) ^ mix64(doc.view(np.uint64)) ^ pos.astype(np.uint64)) % np.uint64(share) == 0
            yield pa.record_batch([pa.array(x[kept]) for x in (seed, doc, pos)], names=["seed", "doc", "pos"])

    return run


def planes(x: np.ndarray) -> np.ndarray:
    """All first bytes of the numbers, then all second ones, and so on: equal ones stand together."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).ravel()


def block_of(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Seeds as bytes: documents and places as differences from the row before, compressed."""
    held = np.concatenate([planes(seed), planes(np.diff(doc, prepend=np.int64(0))), planes(np.diff(pos, prepend=np.int32(0)))])
    return pa.Codec("zstd", compression_level=1).compress(held.tobytes(), asbytes=True)


def rows_of(n: int, held: bytes) -> list[np.ndarray]:
    """(seed, doc, pos) of :func:`block_of`."""
    raw = np.frombuffer(pa.Codec("zstd").decompress(held, decompressed_size=20 * n, asbytes=True), np.uint8)
    seed, doc, pos = (np.ascontiguousarray(raw[lo * n:hi * n].reshape(hi - lo, n).T).ravel().view(t) for lo, hi, t in ((0, 8, np.int64), (8, 16, np.int64), (16, 20, np.int32)))
    return [seed, np.cumsum(doc, dtype=np.int64), np.cumsum(pos, dtype=np.int32)]


def blocks_in(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray, range_: np.ndarray) -> pa.RecordBatch:
    """Rows BLOCK: the seeds of each range, in the order given."""
    order = np.argsort(range_, kind="stable")
    range_, seed, doc, pos = range_[order], seed[order], doc[order], pos[order]
    at = np.concatenate([np.flatnonzero(np.diff(range_, prepend=-1)), [len(range_)]])
    held = [block_of(seed[a:b], doc[a:b], pos[a:b]) for a, b in zip(at, at[1:], strict=False)]
    return pa.record_batch([pa.array(range_[at[:-1]].astype(np.int32)), pa.array(np.diff(at).astype(np.int32)), pa.array(held, pa.binary())], names=["range", "n", "held"])


def seeds_of(docs: DataFrame, k: int, window: int, ranges: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """All seeds of ``docs`` as rows BLOCK: a row for a slice of texts and a range."""
    def run(batches):
        for batch in text_slices(batches):
            seed, doc, pos = seeds_in_slice(batch, k, window)
            yield blocks_in(seed, doc, pos, range_of(seed, doc, ranges))

    return docs.mapInArrow(run, BLOCK)


class FenwickMax:
    """Largest (value, owner) over prefixes of 0 .. n - 1."""

    def __init__(self, n: int):
        self.n, self.best = n, [(-np.inf, -1)] * (n + 1)

    def put(self, i: int, value: float, owner: int):
        i += 1
        while i <= self.n:
            if value > self.best[i][0]:
                self.best[i] = (value, owner)
            i += i & -i

    def top(self, i: int) -> tuple[float, int]:
        """Over 0 .. i - 1."""
        out = (-np.inf, -1)
        while i > 0:
            if self.best[i][0] > out[0]:
                out = self.best[i]
            i -= i & -i
        return out


def chain(p: np.ndarray, h: np.ndarray, k: int) -> list[list[tuple[int, int, int]]]:
    """Chains of matches (p ascending, then h): lists of blocks
    (start here, start there, words), each block on one diagonal.

    Matches that follow each other on a diagonal within REACH are one block from
    the outset. A chain's score is its seeds' scores less GAP_COST for each word
    that it advances, mean of both sides: score(i) = own(i) + max(0, max over
    blocks j that end before i on both sides of score(j) - gap(j, i)). As
    gap(j, i) is a difference of one term of i and one of j, the inner maximum is
    a prefix maximum over end positions there. The best chain is taken first,
    then the best of what is left.
    """
    cut = np.flatnonzero((np.diff(p - h) != 0) | (np.diff(p) > REACH)) + 1
    lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
    ps, hs, pe, he = p[lo], h[lo], p[hi], h[hi]
    own = SEED_SCORE * (hi - lo + 1) - GAP_COST * (pe - ps)
    n = len(lo)
    if n == 1:
        return [[(int(ps[0]), int(hs[0]), int(pe[0] - ps[0]) + k)]]
    places = np.unique(he)
    rank_end, rank_start = np.searchsorted(places, he).tolist(), np.searchsorted(places, hs).tolist()
    tree = FenwickMax(len(places))
    score, before = own.tolist(), [-1] * n
    end_order, e = np.argsort(pe, kind="stable").tolist(), 0
    ps_, pe_, hs_, he_ = ps.tolist(), pe.tolist(), hs.tolist(), he.tolist()
    half = GAP_COST / 2
    for i in range(n):  # by start here; ends here are put in as they are passed
        while e < n and pe_[end_order[e]] < ps_[i]:
            j = end_order[e]
            tree.put(rank_end[j], score[j] + half * (pe_[j] + he_[j]), j)
            e += 1
        value, j = tree.top(rank_start[i])
        if j >= 0 and value - half * (ps_[i] + hs_[i]) > 0:
            score[i] += value - half * (ps_[i] + hs_[i])
            before[i] = j
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda x: -score[x]):
        blocks = []
        while i >= 0 and not used[i]:
            used[i] = True
            blocks.append((ps_[i], hs_[i], pe_[i] - ps_[i] + k))
            i = before[i]
        if blocks:
            out.append(blocks[::-1])
    return out


MATCH = "seed long, doc long, origin long, pos int, there int, kind int"
#: Kinds of rows: a match; one whose origin, or whose neighbour, may stand in an
#: earlier range; a range's last seed with its first (doc, pos) and last (origin, there).
DONE, OPEN_ORIGIN, OPEN_NEIGHBOUR, RANGE_END = range(4)


def sorted_ranges(batches):
    """Rows SEED from rows BLOCK, which come sorted by range: a batch for each
    range, by seed, doc, pos. Seeds that stand alone go, but for those at the
    range's ends: there they may stand in the next one."""
    def of(blocks):
        seed, doc, pos = (np.concatenate(x) for x in zip(*blocks, strict=True))
        order = np.argsort(seed)
        ranked = seed[order]
        same = np.flatnonzero(ranked[1:] == ranked[:-1])
        tied = np.zeros(len(seed), bool)
        tied[same] = tied[same + 1] = True
        tied[(ranked == ranked[0]) | (ranked == ranked[-1])] = True
        order = order[tied]
        order = order[np.lexsort((pos[order], doc[order], seed[order]))]
        return pa.record_batch([pa.array(x[order]) for x in (seed, doc, pos)], names=["seed", "doc", "pos"])

    now, blocks = None, []
    for batch in batches:
        for range_, n, held in zip(*(batch.column(c).to_pylist() for c in ("range", "n", "held")), strict=True):
            if range_ != now and blocks:
                yield of(blocks)
                blocks = []
            now = range_
            blocks.append(rows_of(n, held))
    if blocks:
        yield of(blocks)


def linked(batches):
    """MATCH rows of one range of seeds, which come sorted by seed, doc, pos: each
    occurrence with its seed's first document and with the one before its own."""
    names = ["seed", "doc", "origin", "pos", "there", "kind"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    rest, begin, origin, before = None, None, None, None  # begin: the range's first seed; origin, before: (doc, place) in the seed at hand

    def links(seed, doc, pos):
        nonlocal begin, origin, before, last
        at = np.flatnonzero(np.concatenate([[True], (np.diff(seed) != 0) | (np.diff(doc) != 0)]))
        size = np.diff(np.concatenate([at, [len(seed)]]))
        s, d, there = seed[at], doc[at], pos[at + size - 1].astype(np.int64)  # the one place that is not below 0 comes last
        begin = s[0] if begin is None else begin
        known = [origin, before] if last == s[0] else []
        s = np.concatenate([np.full(len(known), s[0]), s])
        d, there = np.concatenate([np.array([x[0] for x in known], np.int64), d]), np.concatenate([np.array([x[1] for x in known], np.int64), there])
        new = np.concatenate([[True], np.diff(s) != 0])
        first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
        group = np.repeat(np.arange(len(known), len(s)), size)
        place = np.where(pos < 0, -1 - pos, pos)
        opens = s[group] == begin
        near = ~new[group]
        for rows, other, kind in ((np.flatnonzero(near | opens), first, np.where(opens, OPEN_ORIGIN, DONE)),
                                  (np.flatnonzero(near & (opens | (group - 1 != first[group]))), np.arange(len(s)) - 1, np.full(len(group), DONE)),
                                  (np.flatnonzero(opens & ~near), np.arange(len(s)), np.full(len(group), OPEN_NEIGHBOUR))):
            to = other[group[rows]]
            if len(rows):
                named = np.where(kind[rows] == DONE, seed[rows] & 1, seed[rows])  # which seed matters at the ends of ranges only
                yield pa.record_batch([pa.array(x, t) for x, t in zip((named, doc[rows], d[to], place[rows], there[to], kind[rows]), types, strict=True)], names=names)
        last, origin, before = s[-1], (d[first[-1]], there[first[-1]]), (d[-1], there[-1])

    last = None
    for batch in batches:
        now = [batch.column(c).to_numpy() for c in ("seed", "doc", "pos")]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if not len(now[0]):
            continue
        new = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0)) + 1
        cut = new[-1] if len(new) else 0  # the last document's rows may go on
        rest = [x[cut:] for x in now]
        if cut:
            yield from links(*(x[:cut] for x in now))
    if rest is not None:
        yield from links(*rest)
        end = (last, origin[0], before[0], origin[1], before[1], RANGE_END)
        yield pa.record_batch([pa.array([x], t) for x, t in zip(end, types, strict=True)], names=names)


def packed(pos: np.ndarray, there: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Both places of a match and whether its seed is long, as one number that sorts like them."""
    return (pos.astype(np.int64) << 32) | (there.astype(np.int64) << 1) | long


def unpacked(at: np.ndarray) -> list[np.ndarray]:
    return [at >> 32, (at >> 1) & 0x7FFFFFFF, at & 1]


def matches_of(seeds: DataFrame) -> DataFrame:
    """:func:`matched` of seeds as rows (seed, doc, pos, range)."""
    def run(batches):
        for batch in batches:
            yield blocks_in(*(batch.column(c).to_numpy() for c in ("seed", "doc", "pos", "range")))

    return matched(seeds.mapInArrow(run, BLOCK), 1)


def matched(blocks: DataFrame, parts: int) -> DataFrame:
    """(doc, origin, at): each seed of a document with the seed's place in the
    first document that has it, and in the last one before its own (``at``:
    :func:`packed`); at most two rows for an occurrence. Ranges of (seed, doc)
    are worked on, so that one that many documents share is dealt over tasks;
    ``blocks`` name theirs in the column ``range``, ``parts`` of them for a task."""
    n = shuffle_partitions(blocks.sparkSession)
    ranges = blocks.repartitionById(n, F.expr(f"range div {parts}").cast("int")).sortWithinPartitions("range")
    rows = store(ranges.mapInArrow(lambda batches: linked(sorted_ranges(batches)), MATCH), "matches")
    ends = {}  # the seeds that ranges end with: a row for a range
    for r in rows.where(F.col("kind") == RANGE_END).collect():
        ends.setdefault(r.seed, set()).update([(r.doc, r.pos), (r.origin, r.there)])
    ends = {s: tuple(np.array(x, np.int64) for x in zip(*sorted(e), strict=True)) for s, e in ends.items()}

    def run(batches):
        for batch in batches:
            seed, doc, origin, pos, there, kind = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("seed", "doc", "origin", "pos", "there", "kind"))
            opens = np.flatnonzero(kind != DONE)
            for s in np.unique(seed[opens]):
                docs, places = ends.get(int(s), (np.zeros(0, np.int64),) * 2)
                if not len(docs):
                    continue
                at = opens[(seed[opens] == s) & (kind[opens] == OPEN_ORIGIN) & (origin[opens] > docs[0])]
                origin[at], there[at] = docs[0], places[0]
                at = opens[(seed[opens] == s) & (kind[opens] == OPEN_NEIGHBOUR) & (doc[opens] > docs[0])]
                to = np.searchsorted(docs, doc[at]) - 1
                origin[at], there[at] = docs[to], places[to]
            keep = origin < doc
            yield pa.record_batch([pa.array(x[keep], pa.int64()) for x in (doc, origin, packed(pos, there, seed & 1))], names=["doc", "origin", "at"])

    return rows.where(F.col("kind") != RANGE_END).mapInArrow(run, "doc long, origin long, at long")


def spelled(doc: np.ndarray, origin: np.ndarray, pos: np.ndarray, there: np.ndarray, long: np.ndarray, at: np.ndarray, k: int):
    """Matches with long ones as their runs of k words, each once, and the groups' ends."""
    group = np.repeat(np.arange(len(at) - 1), np.diff(at))
    far = np.flatnonzero(long)
    rows = np.concatenate([np.arange(len(doc))] + [far] * (LONG - 1))
    more = np.repeat(np.arange(LONG) * k, [len(doc)] + [len(far)] * (LONG - 1))
    p, h = pos[rows].astype(np.int64) + more, there[rows].astype(np.int64) + more
    order = np.lexsort((h, p, group[rows]))
    group, p, h, rows = group[rows][order], p[order], h[order], rows[order]
    one = np.concatenate([[True], (np.diff(group) != 0) | (np.diff(p) != 0) | (np.diff(h) != 0)])
    group, p, h, rows = group[one], p[one], h[one], rows[one]
    return doc[rows], origin[rows], p, h, np.searchsorted(group, np.arange(len(at)))


def chains_of(matches: DataFrame, k: int) -> DataFrame:
    """(doc, origin, n, blocks): all chains, of one seed too; ``blocks`` are flat
    triples of :func:`chain`."""
    def groups(batches):
        """Arrays of whole (doc, origin) groups; rows come sorted."""
        rest = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("doc", "origin", "at")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if not len(now[0]):
                continue
            new = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])) + 1
            last = new[-1] if len(new) else 0
            rest = [x[last:] for x in now]
            if last:
                yield [x[:last] for x in now], np.concatenate([[0], new])
        if rest is not None and len(rest[0]):
            yield rest, np.array([0, len(rest[0])])

    def run(batches):
        for rows, at in groups(batches):
            doc, origin, pos, there, at = spelled(*rows[:2], *unpacked(rows[2]), at, k)
            types = [pa.int64(), pa.int64(), pa.int32()]
            names = ["doc", "origin", "n", "blocks"]
            # groups of one block, without a loop
            apart = (np.diff(pos - there) != 0) | (np.diff(pos) > REACH) | (np.diff(pos) <= 0)
            cuts = np.concatenate([[0], np.cumsum(apart)])
            single = cuts[at[1:] - 1] == cuts[at[:-1]]
            lo, hi = at[:-1][single], at[1:][single] - 1
            flat = np.stack([pos[lo], there[lo], pos[hi] - pos[lo] + k], axis=1).astype(np.int32).ravel()
            if len(lo):
                blocks = pa.ListArray.from_arrays(pa.array(np.arange(len(lo) + 1, dtype=np.int32) * 3), pa.array(flat))
                yield pa.record_batch([*(pa.array(x, t) for x, t in zip((doc[lo], origin[lo], np.zeros(len(lo))), types, strict=True)), blocks], names=names)
            rows = [(doc[at[g]], origin[at[g]], n, [x for b in blocks for x in b])
                    for g in np.flatnonzero(~single) for n, blocks in enumerate(chain(pos[at[g]:at[g + 1]], there[at[g]:at[g + 1]], k))]
            if rows:
                *own, blocks = zip(*rows, strict=True)
                yield pa.record_batch([*(pa.array(x, t) for x, t in zip(own, types, strict=True)), pa.array(blocks, pa.list_(pa.int32()))], names=names)

    return (matches.repartition(shuffle_partitions(matches.sparkSession), "doc", "origin").sortWithinPartitions("doc", "origin", "at")
            .mapInArrow(run, "doc long, origin long, n int, blocks array<int>"))


def word_bytes(hashes: np.ndarray) -> np.ndarray:
    """16 bits of each word's hash. Unequal words look equal once in 65536 times."""
    return (hashes >> np.uint64(48)).astype("<u2")


def binaries(known: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Words ``known`` as one binary for each text or slice; ``ends`` count words, from 0."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 2).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(known))])


def words_of(docs: DataFrame) -> DataFrame:
    """(text_of, words): 16 bits for each word of a text; texts without words go."""
    def run(batches):
        for batch in text_slices(batches):
            words = Words(batch.column("text"))
            rows = pa.record_batch([batch.column("doc"), binaries(word_bytes(words.hashes()), words.offsets)], names=["text_of", "words"])
            yield rows.filter(pa.array(np.diff(words.offsets) > 0))

    return docs.mapInArrow(run, "text_of long, words binary")


class Slices:
    """Words around chains, on one side each: ``fixed`` has the columns doc, origin,
    turn, lo, words and block numbers in it; ``turn`` is twice the chain's number,
    one more on the origin's side. ``words`` and ``blocks`` are all of theirs in turn."""

    def __init__(self, fixed: np.ndarray, words: np.ndarray, blocks: np.ndarray):
        self.fixed, self.words, self.blocks = fixed, words, blocks

    @staticmethod
    def joined(all_: list[Slices]) -> Slices:
        return Slices(*(np.concatenate([getattr(x, c) for x in all_], axis=a) for c, a in (("fixed", 1), ("words", 0), ("blocks", 0))))

    def ends(self, column: int) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.fixed[column])])

    def take(self, rows: np.ndarray) -> Slices:
        held = []
        for column, values in ((4, self.words), (5, self.blocks)):
            size = self.fixed[column, rows]
            held.append(values[np.repeat(self.ends(column)[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())])
        return Slices(self.fixed[:, rows], *held)

    def pack(self) -> bytes:
        raw = b"".join([*(planes(np.diff(x, prepend=np.int64(0))).tobytes() for x in self.fixed), planes(self.blocks).tobytes(), self.words.tobytes()])
        return pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)

    @staticmethod
    def unpack(n: int, words: int, blocks: int, held: bytes) -> Slices:
        raw = np.frombuffer(pa.Codec("zstd").decompress(held, decompressed_size=48 * n + 4 * blocks + 2 * words, asbytes=True), np.uint8)
        fixed = np.ascontiguousarray(raw[:48 * n].reshape(6, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(6, n)
        own = np.ascontiguousarray(raw[48 * n:48 * n + 4 * blocks].reshape(4, blocks).T).view(np.int32).ravel()
        return Slices(np.cumsum(fixed, axis=1, dtype=np.int64), raw[48 * n + 4 * blocks:].view("<u2"), own)

    def in_buckets(self, buckets: int) -> pa.RecordBatch:
        """Rows SLICES: a document's chains, which its length bounds, meet in one
        bucket. Its own slices lie over each other, so they take little room there."""
        bucket = (mix64(self.fixed[0].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        at = np.concatenate([np.flatnonzero(np.diff(bucket[order], prepend=-1)), [len(order)]])
        held = [self.take(order[a:b]) for a, b in zip(at, at[1:], strict=False)]
        columns = (bucket[order[at[:-1]]], np.diff(at), [len(x.words) for x in held], [len(x.blocks) for x in held], [x.pack() for x in held])
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.record_batch([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["bucket", "n", "words", "blocks", "held"])


SLICES = "bucket int, n int, words int, blocks int, held binary"


def slices_of(docs: DataFrame, chains: DataFrame, buckets: int) -> DataFrame:
    """Rows SLICES: the words around each chain, on both sides.

    Texts go to tasks as 16 bits a word, beside what is asked of them, in one
    shuffle. A text that more than REQUESTS slices are asked of goes to several
    tasks, up to the last word asked for; to fewer where it is long, so that the
    copies take no more room than what is asked."""
    last = F.size("blocks")
    ends = lambda at: (F.greatest(F.lit(0), F.element_at("blocks", at + 1) - MARGIN).alias("lo"),
                       (F.element_at("blocks", last - 2 + at) + F.element_at("blocks", last) + MARGIN).alias("hi"))
    turn = lambda side: (F.col("n") * 2 + side).alias("turn")
    wanted = (chains.select(F.col("doc").alias("text_of"), F.col("origin").alias("other"), turn(0), *ends(0), "blocks")
              .union(chains.select(F.col("origin").alias("text_of"), F.col("doc").alias("other"), turn(1), *ends(1), F.lit(None).cast("array<int>"))))
    many = (wanted.groupBy("text_of").agg(F.count("*").alias("asked"), F.max("hi").alias("reach"))
            .select("text_of", "reach", F.ceil(F.col("asked") / F.greatest(F.lit(REQUESTS), F.col("reach") / 8)).cast("int").alias("parts")).where("parts > 1"))
    many = store(many, "parts")
    texts = (words_of(docs).join(many, "text_of", "left")
             .select("text_of", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")).alias("part"), F.lit(None).cast("long").alias("other"), F.lit(-1).alias("turn"),
                     F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(None).cast("array<int>").alias("blocks"),
                     F.expr("if(parts is null, words, substring(words, 1, 2 * reach))").alias("words")))
    asked = (wanted.join(many, "text_of", "left")
             .select("text_of", F.expr("coalesce(pmod(xxhash64(other, turn), parts), 0)").cast("int").alias("part"), "other", "turn", "lo", "hi", "blocks",
                     F.lit(None).cast("binary").alias("words")))

    def run(batches):
        held = None  # the texts of the group at hand
        answers, ready = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            text_of, part, turn, lo, hi = (batch.column(c).to_numpy() for c in ("text_of", "part", "turn", "lo", "hi"))
            group = np.cumsum(np.concatenate([[False], (np.diff(text_of) != 0) | (np.diff(part) != 0)]))
            texts, asked = np.flatnonzero(turn < 0), np.flatnonzero(turn >= 0)
            begins, stops = (np.searchsorted(group[texts], group[asked], side=x) for x in ("left", "right"))
            size = stops - begins  # one; more where rows share an id
            rows = np.repeat(asked, size)
            text = np.repeat(begins, size) + np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
            words = batch.column("words").take(pa.array(texts))
            offsets = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy())]).astype(np.int64) // 2
            known = np.frombuffer(b"".join(words.to_pylist()), "<u2")
            begin, end = (np.minimum(offsets[text] + x[rows], offsets[text + 1]) for x in (lo, hi)) if len(rows) else (rows, rows)
            done = np.cumsum(end - begin)
            at = 0
            while at < len(rows):
                to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + ANSWER_WORDS, side="right")))
                own, size = rows[at:to], (end - begin)[at:to]
                there = (turn[own] & 1) == 1
                other = batch.column("other").take(pa.array(own)).to_numpy()
                place = np.repeat(begin[at:to] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                blocks = batch.column("blocks").take(pa.array(own))
                fixed = [np.where(there, other, text_of[own]), np.where(there, text_of[own], other), turn[own], lo[own], size, blocks.value_lengths().fill_null(0).to_numpy()]
                answers.append(Slices(np.stack([x.astype(np.int64) for x in fixed]), known[place], blocks.flatten().to_numpy().astype(np.int32)))
                ready += len(place)
                at = to
                if ready >= ANSWER_WORDS:
                    yield Slices.joined(answers).in_buckets(buckets)
                    answers, ready = [], 0
            held = batch.take(pa.array(texts[group[texts] == group[-1]]))
        if answers:
            yield Slices.joined(answers).in_buckets(buckets)

    return (texts.union(asked).repartition(shuffle_partitions(docs.sparkSession), "text_of", "part").sortWithinPartitions("text_of", "part", "turn", "lo")
            .mapInArrow(run, SLICES))


def edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words of a best alignment of two short runs (longest common subsequence)."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        up = np.maximum(row[1:], row[:-1] + (b == x))
        row[1:] = np.maximum.accumulate(up)
    return int(row[-1])


def inside(blocks: np.ndarray, a: np.ndarray, b: np.ndarray) -> int:
    """Equal words of a chain's blocks (start in a, start in b, words) and of the gaps
    between them: blocks are compared word by word, gaps by their longest common subsequence."""
    same, pa_, hb_ = 0, None, None
    for p, h, n in blocks.reshape(-1, 3).tolist():
        if pa_ is not None:
            over = max(0, pa_ - p, hb_ - h)  # blocks may overlap by a seed's words
            p, h, n = p + over, h + over, n - over
            if n <= 0:
                continue
            same += edit_matches(a[pa_:p], b[hb_:h])
        same += int((a[p:p + n] == b[h:h + n]).sum())
        pa_, hb_ = p + n, h + n
    return same


class Drawn:
    """Ways to draw one end of many chains out over the words a and b (n, MARGIN)
    beyond it; words that are not there are -1 and -2.

    ``gain[:, i]`` is the best of equal words less SAME for each word, in
    thousandths, when i words of a are taken: over all alignments whose sides
    shift by at most SHIFT words. ``far`` and ``same`` are its words of b and equal words."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        n, steps = a.shape
        shift = np.arange(-SHIFT, SHIFT + 1)
        low = np.int32(-10_000)
        equal = np.where(shift < 0, low, 0) + np.zeros((n, 1), np.int32)
        b = np.concatenate([np.full((n, SHIFT), -2), b, np.full((n, SHIFT), -2)], axis=1)
        self.gain, self.far, self.same = (np.zeros((n, steps + 1), np.int32) for _ in range(3))
        rows = np.arange(n)
        for i in range(1, steps + 1):
            skip = np.concatenate([equal[:, 1:], np.full((n, 1), low)], axis=1)
            equal = np.maximum(equal + (a[:, i - 1:i] == b[:, i - 1:i + 2 * SHIFT]), skip)
            equal = np.maximum.accumulate(equal, axis=1)
            gain = 1000 * equal - (int(1000 * SAME) * np.maximum(i, i + shift)).astype(np.int32)
            best = gain.argmax(axis=1)
            self.gain[:, i], self.far[:, i], self.same[:, i] = gain[rows, best], i + shift[best], equal[rows, best]
        # ends on an equal word only
        self.ends = np.concatenate([np.ones((n, 1), bool), np.diff(self.gain, axis=1) > 0], axis=1)

    def best(self) -> np.ndarray:
        """Words with the largest gain, the most of them."""
        return self.gain.shape[1] - 1 - np.where(self.ends, self.gain, -10**9)[:, ::-1].argmax(axis=1)

    def most(self, spare: np.ndarray) -> np.ndarray:
        """The most words that cost at most ``spare``."""
        return self.gain.shape[1] - 1 - (self.ends & (self.gain >= -spare[:, None]))[:, ::-1].argmax(axis=1)

    def at(self, i: np.ndarray):
        rows = np.arange(len(i))
        return self.far[rows, i], self.same[rows, i], self.gain[rows, i]


def align(blocks: np.ndarray, block_at: np.ndarray, a: np.ndarray, a_at: np.ndarray, a_to: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_to: np.ndarray):
    """Align many chains: (start, stop, start there, stop there, equal words), all
    places within a and b. Chain i has the triples blocks[block_at[i]:block_at[i + 1]]
    and the words a[a_at[i]:a_to[i]] and b[b_at[i]:b_to[i]]. Its ends are drawn out
    as long as the share of equal words grows beyond SAME, and where that makes
    less than a piece, as long as the whole has that share."""
    first, last = block_at[:-1], block_at[1:] - 3
    p, h = a_at + blocks[first], b_at + blocks[first + 1]
    pe, he = a_at + blocks[last] + blocks[last + 2], b_at + blocks[last + 1] + blocks[last + 2]
    same = np.zeros(len(p), np.int64)
    one = np.flatnonzero(first == last)
    size = blocks[first[one] + 2].astype(np.int64)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    if len(one):
        hit = a[np.repeat(p[one], size) + step] == b[np.repeat(h[one], size) + step]
        same[one] = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
    for i in np.flatnonzero(first != last):
        same[i] = inside(blocks[block_at[i]:block_at[i + 1]], a[a_at[i]:a_to[i]], b[b_at[i]:b_to[i]])
    step = np.arange(MARGIN)

    def beyond(words, begin, end, sign, none):
        at = begin[:, None] + sign * step
        real = (at >= end[:, None]) if sign < 0 else (at < end[:, None])
        return np.where(real, words[np.clip(at, 0, len(words) - 1)], none)

    left = Drawn(beyond(a, p - 1, a_at, -1, -1), beyond(b, h - 1, b_at, -1, -2))
    right = Drawn(beyond(a, pe, a_to, 1, -1), beyond(b, he, b_to, 1, -2))
    x, y = left.best(), right.best()
    core = 1000 * same - int(1000 * SAME) * np.maximum(pe - p, he - h)
    short = lambda: pe - p + x + y < PIECE
    y = np.where(short(), np.maximum(y, right.most(np.maximum(0, core + left.at(x)[2]))), y)
    x = np.where(short(), np.maximum(x, left.most(np.maximum(0, core + right.at(y)[2]))), x)
    (xf, xs, _), (yf, ys, _) = left.at(x), right.at(y)
    return p - x, pe + y, h - xf, he + yf, same + xs + ys


def aligned(slices: DataFrame, parts: int) -> DataFrame:
    """(doc, origin, start, stop, there, there_stop, same) of chains that hold up;
    ``parts`` buckets of ``slices`` go to a task, which sorts one at a time."""
    names = ["doc", "origin", "start", "stop", "there", "there_stop", "same"]

    def pieces(rows: Slices, at: np.ndarray):
        """Of whole (doc, origin, n) groups, which begin at the rows ``at``."""
        doc, origin, turn, lo, _, count = rows.fixed
        side = turn & 1
        size = np.diff(np.concatenate([at, [len(side)]]))
        plain = (size == 2) & (side[at] == 0) & (side[np.minimum(at + 1, len(side) - 1)] == 1)
        here, far = [at[plain]], [at[plain] + 1]
        for g in np.flatnonzero(~plain):  # texts that share an id
            of = np.arange(at[g], at[g] + size[g])
            i, j = np.meshgrid(of[side[of] == 0], of[side[of] == 1], indexing="ij")
            here.append(i.ravel())
            far.append(j.ravel())
        here, far = np.concatenate(here), np.concatenate(far)
        ends, of = rows.ends(4), rows.ends(5)
        words, flat = rows.words.astype(np.int64), rows.blocks.astype(np.int64)
        within = np.repeat(here, count[here])
        index = np.arange(len(within)) - np.repeat(np.cumsum(count[here]) - count[here], count[here])
        blocks, block_at = flat[of[within] + index], np.concatenate([[0], np.cumsum(count[here])])
        far_of = np.repeat(far, count[here])
        blocks = blocks - np.where(index % 3 == 0, lo[within], np.where(index % 3 == 1, lo[far_of], 0))
        last = block_at[1:] - 3
        fits = ((blocks[last] + blocks[last + 2] <= ends[here + 1] - ends[here])
                & (blocks[last + 1] + blocks[last + 2] <= ends[far + 1] - ends[far]))  # else another text of the same id
        if not fits.all():
            blocks = blocks[np.repeat(fits, np.diff(block_at))]
            block_at = np.concatenate([[0], np.cumsum(np.diff(block_at)[fits])])
            here, far = here[fits], far[fits]
        if not len(here):
            return
        start, stop, there, there_stop, same = align(blocks, block_at, words, ends[here], ends[here + 1], words, ends[far], ends[far + 1])
        good = (stop - start >= PIECE) & (1000 * same >= int(1000 * SAME) * np.maximum(stop - start, there_stop - there))
        a, b = lo[here] - ends[here], lo[far] - ends[far]
        yield pa.record_batch([pa.array(doc[here][good]), pa.array(origin[here][good]), *(pa.array(x[good].astype(np.int32)) for x in (start + a, stop + a, there + b, there_stop + b, same))],
                              names=names)

    def bucket_of(held: list[Slices]):
        rows = Slices.joined(held)
        order = np.lexsort((rows.fixed[2], rows.fixed[1], rows.fixed[0]))
        keys = rows.fixed[:3, order]
        keys[2] >>= 1
        at = np.flatnonzero(np.concatenate([[True], (np.diff(keys, axis=1) != 0).any(axis=0)]))
        lo = 0
        while lo < len(at):
            to = max(lo + 1, int(np.searchsorted(at, at[lo] + ALIGNED_SLICES)))
            stop = at[to] if to < len(at) else len(order)
            yield from pieces(rows.take(order[at[lo]:stop]), at[lo:to] - at[lo])
            lo = to

    def run(batches):
        now, held = None, []
        for batch in batches:
            for bucket, *own in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "words", "blocks", "held")), strict=True):
                if bucket != now and held:
                    yield from bucket_of(held)
                    held = []
                now = bucket
                held.append(Slices.unpack(*own))
        if held:
            yield from bucket_of(held)

    n = shuffle_partitions(slices.sparkSession)
    return (slices.repartitionById(n, F.expr(f"bucket div {parts}").cast("int")).sortWithinPartitions("bucket")
            .mapInArrow(run, "doc long, origin long, start int, stop int, there int, there_stop int, same int"))


def passages(docs: DataFrame, k: int = K, window: int = WINDOW, least: int = LEAST) -> DataFrame:
    """(doc_id, start_word, stop_word, n_words, same, first_id): the passages of at
    least ``least`` words that each document shares with documents of smaller
    ids; words count from 0, ``first_id`` is the smallest id of those documents,
    ``same`` the share of equal words in the passage's pieces."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("doc"), "text")
    n = shuffle_partitions(docs.sparkSession)
    ranges, parts = ranges_of(docs, k, window, n)
    chains = store(chains_of(matched(seeds_of(docs, k, window, ranges), parts), k), "chains")
    parts = max(1, -(-2 * chains.count() // (n * BUCKET_SLICES)))
    pieces = aligned(slices_of(docs, chains, n * parts), parts)
    by_start = Window.partitionBy("doc").orderBy("start", "stop", "origin")
    pieces = pieces.withColumn("reach", F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    pieces = pieces.withColumn("passage", F.sum(F.when(F.col("start") <= F.col("reach") + JOIN, 0).otherwise(1)).over(by_start))
    return (pieces.groupBy("doc", "passage")
            .agg(F.min("start").alias("start_word"), F.max("stop").alias("stop_word"), F.min("origin").alias("first"),
                 (F.sum("same") / F.sum(F.greatest(F.col("stop") - F.col("start"), F.col("there_stop") - F.col("there")))).alias("same"))
            .where(F.col("stop_word") - F.col("start_word") >= least)
            .select(F.nullif("doc", F.lit(FIRST)).alias("doc_id"), "start_word", "stop_word",
                    (F.col("stop_word") - F.col("start_word")).alias("n_words"), "same", F.nullif("first", F.lit(FIRST)).alias("first_id")))


def op10_passages(docs: DataFrame) -> DataFrame:
    return passages(docs)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words start .. stop - 1 of each span."""
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, stop in spans:
        stop = min(stop, len(words))
        if start >= stop:
            continue
        out.append(text[at:words[start][0]])
        at = words[stop][0] if stop < len(words) else len(text)
    return "".join(out) + text[at:]


def cut_passages(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without their passages: the texts' words go, the first document
    keeps them; a document of which no word is left goes too. Texts without
    passages are left as they are."""
    found = (passages(docs, **options).groupBy(F.col("doc_id").alias("__cut_id"))
             .agg(F.array_sort(F.collect_list(F.struct("start_word", "stop_word"))).alias("__cuts")))  # bounded by the text
    columns = docs.columns
    place = columns.index("text")
    found = store(found, "cuts")  # of known size: while it is small, the texts stay where they are
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__cut_id")), "left").select(*columns, "__cuts")

    def run(batches):
        for batch in text_slices(batches):
            cuts = batch.column(len(columns)).to_pylist()
            texts = batch.column(place).to_pylist()
            keep = np.ones(len(texts), bool)
            for i, spans in enumerate(cuts):
                if spans and texts[i] is not None:
                    texts[i] = without(texts[i], [(s["start_word"], s["stop_word"]) for s in spans])
                    keep[i] = WORD.search(texts[i]) is not None
            own = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(columns))]
            yield pa.record_batch(own, names=columns).filter(pa.array(keep))

    return joined.mapInArrow(run, docs.schema)
