import bisect
import zlib

import pytest
from tokenizers import Tokenizer

from stratus.llm import mixing, packing
from stratus.llm.queries import QUERIES
from tests.llm.helpers import no_docs, odd_docs, rng, row, SCHEMA

SF = "/root/testdata/sf0.001"


def test_mix_reaches_targets_and_agrees_with_reruns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in mixing.op7_mix(docs).collect()]
    again = {r.doc_id: r.taken for r in mixing.op7_mix(docs.repartition(7)).collect()}
    assert {r["doc_id"]: r["taken"] for r in rows} == again
    source = {r.doc_id: r.source for r in docs.collect()}
    total = sum(r["size"] for r in rows)
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = source[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = (r["target"], r["source_size"])
    for s, (t, size) in target.items():
        assert abs(taken[s] - t) <= 1 and t <= 2 * size + 1e-6
    assert sum(t for t, _ in target.values()) == pytest.approx(1.5 * total)


def test_water_filling_shares_excess_by_weight(spark):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(
        [("a", 100, 5.0), ("b", 1000, 2.0), ("c", 1000, 1.0)], "source string, source_size long, weight double"), 1.5, 2).collect()}
    # a stops at 200; the other 2950 are shared 2 : 1
    assert got["a"] == 200 and got["b"] == pytest.approx(2950 * 2 / 3) and got["c"] == pytest.approx(2950 / 3)


def test_mix_odd_inputs(spark):
    rows = mixing.op7_mix(odd_docs(spark)).collect()
    assert len(rows) == 14
    assert all(r.taken == 0 for r in rows if r.size == 0) and sum(r.size == 0 for r in rows) == 4
    assert mixing.op7_mix(no_docs(spark)).collect() == []
    out = mixing.apply_mix(odd_docs(spark))
    assert out.columns == odd_docs(spark).columns
    assert out.where("text is null").count() == 0


def test_mix_hot_source_spreads_over_slices(spark):
    docs = spark.createDataFrame([row(i, "w " * (i % 5 + 1), source="hot" if i % 3 else "b") for i in range(3000)], SCHEMA)
    rows = mixing.mix(docs).collect()
    for s in ("hot", "b"):
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1


def naive_best_fit(lengths, capacity):
    free, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(free, length)
        if i < len(free):
            bisect.insort(free, free.pop(i) - length)
        else:
            n += 1
            bisect.insort(free, capacity - length)
    return n


def test_plan_equals_best_fit_decreasing_one_by_one():
    r = rng()
    for _ in range(60):
        capacity = r.choice([10, 64, 2048])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 300))] + [max(1, capacity // 7)] * r.randint(0, 200)
        histogram = {}
        for x in lengths:
            histogram[x] = histogram.get(x, 0) + 1
        filled, seen = {}, set()
        for length, rank, count, first, offset in packing.plan_packing(histogram, capacity).tolist():
            for i in range(count):
                assert (length, rank + i) not in seen
                seen.add((length, rank + i))
                filled.setdefault(first + i, []).append((offset, length))
        assert len(seen) == len(lengths) and len(filled) == naive_best_fit(lengths, capacity)
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity


def check_packing(docs, rows, capacity=2048):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = []
    for d in docs:
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0]
        for p, s in enumerate(range(0, len(ids), capacity)):
            cut = ids[s:s + capacity]
            want.append((d.doc_id, p, s, len(cut), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in cut))))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(want, key=key) == sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key)
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == naive_best_fit([r.length for r in rows], capacity)


def test_packing_against_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_packing(docs, QUERIES["op2_packing"](spark, SF).collect())


def test_packing_odd_inputs(spark):
    check_packing(odd_docs(spark).collect(), packing.op2_packing(odd_docs(spark)).collect())
    assert packing.op2_packing(no_docs(spark)).collect() == []


def test_word_encoder_on_awkward_words():
    import pyarrow as pa
    texts = ["don't  I'LL say'S x<|endoftext|>y <|startoftext|> <| endoftext|>", "É ñ ﬁ ½ 12ab34 a_b ''s 's s'  é ́ z", "", None,
             "\x1c\x85 日本語 İ İ! K ẞ !!!'ll ab!!'ll don't!", "[a]{b}~`^ x@y.z a'b a'' ab's it's"]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids, at = packing.WordEncoder(packing.tokenizer_path()).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
