import random

import public_tokenizers as P
import pytest

import corpus_pipeline
from stratus.llm import token_counts
from stratus.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import SCHEMA, no_docs, odd_docs, row
from tests.llm.test_mixing_packing import check_packing
from tests.llm.test_pairs import naive_components

SF = "/root/testdata/sf0.001"
PARTS = ["a", "b ", " ", "  ", "\n", "'s", "'", "l", "'ll", "1", "12", ".", "!!", "é", "日", "\t", "x'r", "e ", "   ", "\r\n", "the", "ing"]


def test_edits_against_full_encoding():
    counter = token_counts.counter_of(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    r = random.Random(1)
    some = lambda n: "".join(r.choice(PARTS) for _ in range(n))
    for _ in range(500):
        tree = token_counts.Tree(some(r.choice([0, 1, 3, 10, 60, 300])), counter)
        for _ in range(r.randint(1, 5)):
            text = tree.text
            at = r.randint(0, len(text))
            cut, put = r.randint(0, min(r.choice([0, 3, 30]), len(text) - at)), some(r.choice([0, 0, 1, 3, 20]))
            tree.edit(at, cut, put)
            assert tree.text == text[:at] + put + text[at + cut:]
            assert tree.total() == len(counter.encoding.encode_ordinary(tree.text))


def test_counts_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counter = token_counts.counter_of(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts = {r.doc_id: r for r in docs.select("doc_id", "text", token_counts.revision(docs.text, docs.source).alias("edits")).collect()}
    for r in token_counts.op6_token_counts(docs).collect():
        text, own = texts[r.doc_id].text, texts[r.doc_id]
        assert r.n_tokens == len(counter.encoding.encode_ordinary(text))
        for at, cut, put in token_counts.in_order([e.asDict() for e in own.edits], len(text)):
            text = text[:at] + put + text[at + cut:]
        assert r.edited_tokens == len(counter.encoding.encode_ordinary(text))
        assert r.recounted <= 120 or r.recounted <= r.n_pretokens + 60


def test_edit_tables_and_clipping(spark):
    edits = spark.createDataFrame([(1, 3, 50, "x"), (1, 1, 4, "yy"), (2, 99, 1, "z"), (2, -5, None, None)], "doc_id long, at int, cut int, put string")
    docs = spark.createDataFrame([row(1, "abcdef"), row(2, "hi"), row(3, "none"), row(None, None)], SCHEMA)
    got = {r.doc_id: r for r in token_counts.count_edited(token_counts.with_edits(docs, edits)).collect()}
    count = lambda t: len(token_counts.counter_of(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encoding.encode_ordinary(t))
    assert got[1].edited_tokens == count("ayyx") and got[2].edited_tokens == count("hiz")
    assert got[3].edited_tokens == got[3].n_tokens == count("none") and got[None].n_tokens == 0


def test_counts_odd_inputs(spark):
    assert len(token_counts.op6_token_counts(odd_docs(spark)).collect()) == 14
    assert token_counts.op6_token_counts(no_docs(spark)).collect() == []


# --- pipeline -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = odd_docs(spark).select(*docs.columns)
    inputs, out = docs.union(odd), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.store(stage(spark, inputs, SF), f"test-{name}")
        out.append((inputs, after))
        inputs = after
    return out


def test_stages_keep_columns_and_clean_documents(spark, stages):
    documents = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [a.columns for _, a in stages[:4]] == [documents] * 4
    before, after = stages[0]
    gone = before.exceptAll(after).collect()
    assert all(not any(c.isalpha() for c in r.text or "") or r.doc_id in (None, 5, 7, 10) or r.doc_id < 12 for r in gone)


def test_near_dedup_stage_keeps_one_of_each_group(spark, stages):
    before, after = stages[1]
    rows = [(i, r.text) for i, r in enumerate(sorted(before.collect(), key=lambda r: (r.doc_id is None, r.doc_id)))]
    groups, _ = naive_components(rows, 5, 80)
    assert after.count() == len(set(groups.values()))


def test_mix_and_pack_stages(spark, stages):
    before, after = stages[3]
    assert after.exceptAll(before.union(before)).count() == 0
    docs, packed = stages[4]
    check_packing(docs.collect(), packed.collect())


def test_run_returns_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.near_dedup(spark, no_docs(spark), SF).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
