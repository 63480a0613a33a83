import re
import string
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import ann, neardup, passages
from stratus.llm.common import components, store
from tests.llm.helpers import SCHEMA, no_docs, odd_docs, prose, rng, row

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


class Groups:
    def __init__(self, nodes):
        self.up = {x: x for x in nodes}

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.top(a), self.top(b)))
        self.up[b] = a


def naive_components(docs, k, percent):
    """{doc_id: component_id} by comparing every pair that shares a shingle."""
    sets = {d: shingles(t, k) for d, t in docs}
    having, groups = defaultdict(list), Groups(sets)
    for d, s in sets.items():
        for g in s:
            having[g].append(d)
    for d, s in sets.items():
        for e in {e for g in s for e in having[g] if e < d}:
            both = len(s & sets[e])
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                groups.join(d, e)
    return {d: groups.top(d) for d in sets}, sets


# --- near duplicates ------------------------------------------------------------

def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[101] == 100


def test_near_duplicates_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = neardup.op3_neardup(docs).collect()
    want, sets = naive_components([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in rows)


def test_family_of_near_copies_around_the_threshold(spark):
    """Many different copies of one text, most pairs close to the threshold: no
    link may be lost, and the family must not be expanded into all pairs."""
    r = rng(11)
    base = prose(r, 160).split()
    docs = []
    for i in range(260):
        own = list(base)
        for _ in range(r.randint(0, 9)):
            own[r.randrange(len(own))] = f"edit{i}_{r.random()}"
        docs.append((i, " ".join(own)))
    docs += [(1000 + i, prose(r, 50)) for i in range(20)]
    want, _ = naive_components(docs, 3, 85)
    got = neardup.op3_neardup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == want and len(set(want.values())) > 40


def test_near_duplicates_odd_inputs(spark):
    rows = neardup.op3_neardup(odd_docs(spark)).collect()
    assert len(rows) == 14
    own = defaultdict(set)
    for r in rows:
        own[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert own[1] == {(0, 1, True)} and own[2] == {(0, 2, True)} and own[4] == {(1, 4, True)}
    assert own[8] == {(5, 8, True)} and (5, 8, False) in own[9]
    assert neardup.op3_neardup(no_docs(spark)).collect() == []
    kept = neardup.drop_near_duplicates(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.where("text like 'the same text%'").count() == 1
    assert kept.where("text like 'another%'").count() == 1


def test_few_copies_leave_the_texts_where_they_are(spark):
    ids = [x * 7_919_999_999 for x in range(1, 2001)]
    docs = spark.createDataFrame([(d, f"text {d % 991 if d > ids[-21] else d} of some words") for d in ids] + [(None, "no id")], "doc_id long, text string")
    texts = {}
    for d, text in sorted((r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()):
        texts.setdefault(text, d)
    docs = docs.union(docs.where(F.col("doc_id") <= ids[19]).withColumn("doc_id", F.col("doc_id") + ids[-1]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")  # the ids that stay take more, those that go less
    try:
        out = neardup.drop_near_duplicates(docs)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert {r.doc_id for r in out.collect()} == {None, *texts.values()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sketch_weight_estimates_similarity():
    r = np.random.default_rng(2)
    for share in (0.95, 0.85, 0.7):
        n = 3000
        weights = []
        for _ in range(12):
            pool = r.integers(0, 2**63, 2 * n, np.uint64)
            both = int(2 * n * share / (1 + share))
            a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n:2 * n - both]]))
            sets, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            s = neardup.odd_sketches(neardup.signatures(sets, at, 25, 5), 256)
            weights.append(int(np.bitwise_count(s[0] ^ s[1]).sum()))
        assert np.mean(weights) == pytest.approx(neardup.most_bits(share, 256, 125), abs=8)


# --- passages ---------------------------------------------------------------------

def test_passages_cover_exact_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spans = defaultdict(list)
    for r in passages.op10_passages(docs).collect():
        assert r.first_id < r.doc_id and r.n_words >= 50 and 0.8 <= r.same <= 1
        spans[r.doc_id].append((r.start_word, r.stop_word))
    seen, seen5, repeated, missed = set(), set(), 0, 0
    for d, text in sorted((r.doc_id, r.text) for r in docs.collect()):
        w = words_of(text)
        runs = [tuple(w[i:i + 50]) for i in range(len(w) - 49)]
        short = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        due = {j for i, g in enumerate(runs) if g in seen for j in range(i, i + 50)}
        covered = {j for a, b in spans.get(d, []) for j in range(a, b)}
        repeated, missed = repeated + len(due), missed + len(due - covered)
        for a, b in spans.get(d, []):  # what is reported is mostly shared
            hit = {j for i in range(a, b - 4) if short[i] in seen5 for j in range(i, i + 5)}
            assert len(hit) >= 0.6 * (b - a)
        seen.update(runs)
        seen5.update(short)
    assert repeated > 10_000 and missed < 0.01 * repeated


def test_fuzzy_passage_is_found_and_cut(spark):
    r = rng(3)
    shared = prose(r, 120).split()
    edited = [w if i % 25 else w + "x" for i, w in enumerate(shared) if i != 60]
    docs = [row(1, prose(r, 40) + " " + " ".join(shared) + " " + prose(r, 40)),
            row(2, "Begin here, " + prose(r, 30) + " " + " ".join(edited).upper() + " " + prose(r, 30) + " the end"),
            row(3, prose(r, 200)), row(4, " ".join(shared))]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {x.doc_id: x for x in passages.op10_passages(df).collect()}
    assert set(got) == {2, 4} and got[2].first_id == 1 and abs(got[2].start_word - 32) <= 2 and abs(got[2].stop_word - 151) <= 2
    out = {x.doc_id: x.text for x in passages.cut_passages(df).collect()}
    assert set(out) == {1, 2, 3}  # of the last one nothing is left
    assert out[1] == docs[0][1] and out[3] == docs[2][1] and out[2].startswith("Begin here,") and out[2].endswith("the end")
    assert len(words_of(out[2])) <= 64 + 4


def test_snippets_in_earlier_documents_hide_no_passage(spark):
    """Each short run of the shared passage also stands in another earlier document."""
    r = rng(21)
    shared = prose(r, 60, 5000).split()
    docs = [(i, prose(r, 30, 5000) + " " + " ".join(shared[7 * i:7 * i + 11]) + " " + prose(r, 30, 5000)) for i in range(8)]
    docs += [(i, prose(r, 40, 5000) + " " + " ".join(shared) + " " + prose(r, 40, 5000)) for i in (100, 200)]
    got = passages.op10_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(x.doc_id, x.first_id) for x in got] == [(200, 100)]
    assert got[0].start_word <= 40 and got[0].stop_word >= 100


def edited_pairs(r, n, length, share):
    """Documents 0 .. n - 1 and 1000 .. with a passage of which ``share`` of the words are other ones."""
    docs = []
    for i in range(n):
        shared = prose(r, length, 5000).split()
        other = [f"edit{r.random()}" if r.random() < share else w for w in shared]
        docs += [(i, " ".join([prose(r, 30, 5000), *shared, prose(r, 30, 5000)])), (1000 + i, " ".join([prose(r, 40, 5000), *other, prose(r, 40, 5000)]))]
    return docs


@pytest.mark.parametrize("length, share, least", [(60, 0.05, 0.98), (60, 0.1, 0.9), (80, 0.1, 0.95)])
def test_recall_of_fuzzy_passages(spark, length, share, least):
    got = passages.passages(spark.createDataFrame(edited_pairs(rng(31), 100, length, share), "doc_id long, text string"), least=length // 2).collect()
    assert all(x.first_id == x.doc_id - 1000 and x.same >= 0.8 and 35 <= x.start_word and x.stop_word <= 45 + length for x in got)
    assert len({x.doc_id for x in got}) >= least * 100


def test_matches_do_not_depend_on_ranges(spark):
    """A seed of many documents is dealt over ranges; each meets its first document and the one before its own."""
    rows = [(7 if i % 2 else 8, i, i + 3) for i in range(500)] + [(s, d, 1) for s in range(100, 140) for d in (1, 5, 9)]
    places = sorted(x[:2] for x in rows)
    points = [places[i * len(places) // 4] for i in (1, 2, 3)]  # two of them within a seed's documents
    points = tuple(np.array(x, np.int64) for x in zip(*points, strict=True))
    seed, doc = (np.array([x[i] for x in rows], np.int64) for i in (0, 1))
    dealt = passages.range_of(seed, doc, points).tolist()
    assert dealt == [sum(p < x[:2] for p in zip(*(p.tolist() for p in points), strict=True)) for x in rows] and len(set(dealt)) == 4
    ranges = spark.createDataFrame([(*x, at) for x, at in zip(rows, dealt, strict=True)], "seed long, doc long, pos int, range int")
    got = {(int(long), x.doc, x.origin, int(pos), int(there)) for x in passages.matches_of(ranges).collect() for pos, there, long in [passages.unpacked(np.int64(x.at))]}
    want = set()
    for s in {x[0] for x in rows}:
        of = sorted(x[1:] for x in rows if x[0] == s)
        for i in range(1, len(of)):
            want |= {(s & 1, of[i][0], of[j][0], of[i][1], of[j][1]) for j in (0, i - 1)}
    assert got == want


def test_slices_of_one_document_share_the_room():
    words = np.random.default_rng(3).integers(0, 1 << 16, 3000).astype("<u2")
    lo = np.arange(0, 2900, 5)
    rows = passages.Slices(np.stack([np.full(len(lo), 77), np.arange(len(lo)), np.zeros(len(lo), np.int64), lo, np.full(len(lo), 61), np.zeros(len(lo), np.int64)]),
                           words[(lo[:, None] + np.arange(61)).ravel()], np.zeros(0, np.int32))
    out = rows.in_buckets(16)
    assert out.num_rows == 1  # not one for each of the 16 buckets
    assert len(out.column("held")[0].as_py()) < 2 * words.nbytes < rows.words.nbytes / 5
    again = passages.Slices.unpack(*(out.column(c)[0].as_py() for c in ("n", "words", "blocks", "held")))
    assert (again.fixed == rows.fixed).all() and (again.words == rows.words).all()


def test_stored_tables_leave_no_shuffle_files(spark):
    held = lambda: {str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), held()
    out = store(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test")
    for _ in range(50):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before
    assert sorted(r["count"] for r in out.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert spark.conf.get(name) == setting


def test_chain_is_the_best_ordered_subset():
    r = np.random.default_rng(4)
    for _ in range(40):
        p = np.sort(r.choice(60, 9, replace=False))
        h = r.integers(0, 60, 9)
        blocks = passages.chain(p, h, 5)

        def score(at):
            return sum(passages.SEED_SCORE for _ in at) - sum(
                passages.GAP_COST / 2 * (p[b] - p[a] + h[b] - h[a]) for a, b in zip(at, at[1:], strict=False))
        best = 0
        for mask in range(1, 1 << 9):
            at = [i for i in range(9) if mask >> i & 1]
            if all(h[b] > h[a] for a, b in zip(at, at[1:], strict=False)):
                best = max(best, score(at))
        first = [i for b in blocks[0] for i in range(9) if b[0] <= p[i] <= b[0] + b[2] - 5 and p[i] - h[i] == b[0] - b[1]]
        assert score(first) == pytest.approx(best)


def test_passages_odd_inputs(spark):
    assert passages.op10_passages(odd_docs(spark)).collect() == []
    assert passages.op10_passages(no_docs(spark)).collect() == []
    same = cut = passages.cut_passages(odd_docs(spark))
    assert cut.columns == odd_docs(spark).columns and same.count() == 14
    text = prose(rng(9), 90)
    rows = [row(None, text), row(3, text), row(3, text), row(3, prose(rng(10), 80))]
    got = passages.op10_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(x.doc_id, x.first_id, x.n_words) for x in got} == {(3, None, 90)}


# --- nearest neighbours --------------------------------------------------------------

def naive_neighbours(rows, queries, k):
    out = {}
    for q in queries:
        own = [v for i, v in rows if i == q][0]
        scores = sorted((-float(np.sum(np.asarray(v) * np.asarray(own))), i) for i, v in rows if i != q)
        out[q] = [i for _, i in scores[:k]]
    return out


def test_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, np.asarray(r.embedding, np.float64)) for r in table.collect()]
    of = dict(rows)
    got = defaultdict(list)
    for r in ann.op1_ann(table).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
        assert r.rank == len(got[r.query_id]) and r.score == pytest.approx(float(of[r.query_id] @ of[r.vec_id]), abs=1e-12)
    want = naive_neighbours(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / (20 * len(want)) >= 0.9


def test_neighbours_odd_inputs(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0]), (None, [1.0, 1.0]), (40, []), (9, [-1.0, 0.5]), (1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit(1)).withColumn("v", F.lit("x"))
    got = defaultdict(list)
    for r in ann.op1_ann(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got[0] == [(1, 1.0), (2, 1.0), (20, 0.0), (9, -1.0)]
    assert got[20] == [(1, 2.0), (2, 2.0), (9, 1.0), (0, 0.0)] and set(got) == {0, 20}
    assert ann.op1_ann(df.limit(0)).collect() == []


def test_hot_vector_keeps_ties_by_id(spark):
    r = np.random.default_rng(1)
    rows = [(i, [0.6, 0.8, 0.0, 0.0]) for i in range(300)] + [(300 + i, r.normal(size=4).tolist()) for i in range(100)]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=5, window=1.0).orderBy("rank").collect()
    want = naive_neighbours(rows, [0], 5)[0]
    assert [x.vec_id for x in got] == want


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(range(8), range(8), range(8)), -1).reshape(-1, 3)
    keys = ann.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
