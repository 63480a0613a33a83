import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from stratus.llm import fingerprint, langid, licenses, toxicity
from stratus.llm.common import Words, text_slices
from tests.llm.helpers import LONG, SCHEMA, no_docs, odd_docs, row

SF = "/root/testdata/sf0.01"
BLANK = r"[^\x20\x09-\x0D]+"


def test_words_of_parts_of_batches():
    texts = [f"Ä{i} Word{i}  x\x0by\x1cz" + "é " * i for i in range(50)] + ["", None, " "]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    for part in (batch, batch.slice(7, 20)):
        for one in text_slices([part]):
            words = Words(one.column("text"))
            for i, text in enumerate(one.column("text").to_pylist()):
                own = [words.vocab[c] for c in words.codes[words.offsets[i]:words.offsets[i + 1]]]
                assert own == re.findall(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_text_slices_keep_all_rows(monkeypatch):
    monkeypatch.setattr("stratus.llm.common.SLICE_BYTES", 10)
    batch = pa.record_batch([pa.array(["abc", None, "x" * 50, "", "defgh", "ijk"]), pa.array(range(6))], names=["text", "n"])
    parts = list(text_slices([batch]))
    assert len(parts) > 2 and [n for p in parts for n in p.column("n").to_pylist()] == list(range(6))


# --- fingerprints ---------------------------------------------------------

def test_fingerprints_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprint.op4_fingerprint(docs).collect()}
    assert len(got) == len(texts)
    whole = lambda t: fingerprint.vector(fingerprint.units(t))
    for i, (k, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        n = len(text)
        edited = text[:n - n // 3] + after[:n // 3]
        r = got[k]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprint.encoded(whole(text)) and r.edited_fingerprint == fingerprint.encoded(whole(edited))
        assert r.near_next == fingerprint.likeness(whole(text), whole(after))
    assert np.mean([r.near_edited for r in got.values()]) > 0.6 > 0.1 > np.mean([r.near_next for r in got.values()])


def test_fingerprints_are_multisets():
    base = fingerprint.vector(fingerprint.units("alpha beta.\ngamma delta.\nepsilon"))
    assert (base == fingerprint.vector(fingerprint.units("epsilon\nalpha beta.\ngamma delta."))).all()
    more = fingerprint.insert(base, "zeta eta")
    assert (more == fingerprint.vector(fingerprint.units("alpha beta.\ngamma delta.\nepsilon\nzeta eta"))).all()
    assert (fingerprint.delete(more, "zeta eta") == base).all()
    assert fingerprint.likeness(base, base) == 1.0


def test_fingerprint_odd_inputs(spark):
    rows = fingerprint.op4_fingerprint(odd_docs(spark)).collect()
    assert len(rows) == 14 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[8][0].fingerprint in [r.fingerprint for r in by[9]]
    assert by[1][0].fingerprint == by[2][0].fingerprint and by[1][0].n_chars == 0
    assert fingerprint.op4_fingerprint(no_docs(spark)).collect() == []
    alone = fingerprint.op4_fingerprint(spark.createDataFrame([row(5, "abc def")], SCHEMA)).collect()
    assert alone[0].near_next == 1.0 and alone[0].edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()


# --- language identification -------------------------------------------------

def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.op5_langid(docs).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    # neither lang of held-out rows nor source is looked at
    hidden = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang) as lang", "'s' as source")
    assert {(r.doc_id, r.lang_pred, r.score) for r in langid.op5_langid(hidden).collect()} == {(r.doc_id, r.lang_pred, r.score) for r in rows}


def model_of(**texts):
    words = {x: Words(pa.array([t])) for x, t in texts.items()}
    n = np.zeros((langid.BUCKETS, len(texts)))
    scripts = np.zeros((len(langid.SCRIPTS), len(texts)), bool)
    for i, w in enumerate(words.values()):
        letters = langid.Letters(w.vocab)
        n[:, i] = np.bincount(letters.buckets, minlength=langid.BUCKETS)
        scripts[letters.script, i] = True
    scripts[0] = True
    n += 0.5
    return langid.Model(list(texts), np.log(n / n.sum(axis=0)).astype(np.float32), scripts)


def test_spans_of_mixed_texts_and_scripts():
    model = model_of(en="the quick brown fox and the other one with that", de="der schnelle braune fuchs und die andere mit das nicht",
                     ru="быстрая коричневая лиса и другая")
    text = "the quick fox and the other one 7 with that der schnelle fuchs und die andere mit das nicht быстрая лиса и другая"
    lang, score, spans = langid.judge(pa.array([text, "быстрая лиса", "7 !!", None, "日本語"]), model)
    spans = spans.to_pylist()
    assert [s["lang"] for s in spans[0]] == ["en", "de", "ru"] and spans[0][0] == {"start": 0, "stop": 10, "lang": "en"}
    assert lang[1] == "ru" and lang[2] == lang[3] == "und" and score[2] == 0 and lang[4] == "en" and score[4] == 0


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(0, 6, 4)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        table = rng.normal(size=(8, 3)).astype(np.float32)
        codes = rng.integers(0, 8, offsets[-1])
        labels = langid.viterbi(table, codes, offsets, switch=0.7)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            def value(path):
                return sum(table[codes[a + i], x] for i, x in enumerate(path)) - 0.7 * sum(x != y for x, y in zip(path, path[1:], strict=False))
            if b > a:
                paths = np.stack(np.meshgrid(*[range(3)] * (b - a)), -1).reshape(-1, b - a)
                assert value(labels[a:b]) == pytest.approx(max(value(p) for p in paths), abs=1e-4)


def test_langid_odd_inputs(spark):
    rows = langid.op5_langid(odd_docs(spark)).collect()
    assert len(rows) == 14
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (1, 2, 3, 6)] == ["und"] * 4
    assert langid.op5_langid(no_docs(spark)).collect() == []
    nothing = spark.createDataFrame([row(1, "abc", None)], SCHEMA)
    assert langid.op5_langid(nothing).collect()[0].lang_pred == "und"
    kept = langid.keep_identified(odd_docs(spark), langid.train(odd_docs(spark)), 0.1)
    assert kept.columns == odd_docs(spark).columns and kept.where("text is null or trim(text) = ''").count() == 0


# --- licenses ---------------------------------------------------------------

def brute_base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENSE_TEXTS = ["", None, "CC-BY cc by cc\x00by cc by-nc 4.0", "x GNU  General\nPublic, License v3 or later", "accby cc bye éMIT license the MIT licenses",
                 "Licensed under the Apache License, Version 2.0; the Apache license", "MIT License MIT License", "gnu general public license " * 3000,
                 "All rights reserved. SPDX-License-Identifier: MPL-2.0", "mit der lizenz", "the CC BY-SA 3.0, LGPL v2.1"]


def test_license_base_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(LICENSE_TEXTS)], "doc_id long, text string"))
    got = {r.doc_id: r for r in licenses.op8_licenses(docs).collect()}
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == brute_base(r.text)
        assert set(filter(None, g.base_labels.split(","))) <= set(filter(None, g.labels.split(","))) and 0 <= g.score <= 1


def test_license_rules_and_suppression(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(LICENSE_TEXTS)], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.op8_licenses(docs).collect()}
    assert found[3] == "gpl,gpl-3-or-later"  # the bare name is inside the longer notice, the base label stays
    assert found[5] == "apache,apache-2.0" and found[8] == "mpl-2.0,proprietary"
    assert found[9] == "" and found[10] == "cc-by,cc-by-sa-3.0,lgpl-2.1"
    assert len(licenses.rules()) > 200


def spelled_out(expression):
    """Every text that an expression of alternatives and optional parts matches."""
    parser = re._parser

    def texts(items):
        out = [""]
        for op, value in items:
            if op is parser.LITERAL:
                more = [chr(value)]
            elif op is parser.IN:
                more = [chr(v) for o, v in value if o is parser.LITERAL]
            elif op is parser.BRANCH:
                more = [t for branch in value[1] for t in texts(branch)]
            elif op is parser.SUBPATTERN:
                more = texts(value[3])
            elif op is parser.MAX_REPEAT:
                assert value[:2] == (0, 1)
                more = ["", *texts(value[2])]
            else:
                assert op is parser.ASSERT_NOT
                more = [""]
            out = [a + b for a in out for b in more]
        return out

    return texts(parser.parse(expression))


def test_every_license_rule_passes_its_gates():
    for label, keyword, expression, _, _ in licenses.rules():
        for text in spelled_out(expression.removeprefix(licenses.NOTICE)):
            assert re.fullmatch(expression.removeprefix(licenses.NOTICE), text)
            assert f" {keyword}" in f" {text} ", (label, text)
            raw = text.replace(" ", "\n")
            assert any(stem in raw for stem in licenses.STEMS) or re.search(licenses.CC_BY, raw), (label, text)


def test_license_spellings(spark):
    texts = ["GNU Library General Public License version 2", "the MIT licence", "ISC licence", "Artistic Licence 2.0", "PHP licence", "Open Software Licence 3.0",
             "all rights\nreserved", "Creative\nCommons Attribution", "in the public\ndomain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in licenses.op8_licenses(docs).orderBy("doc_id").collect()] == [
        "lgpl-2", "mit", "isc", "artistic-2.0", "php", "osl-3.0", "proprietary", "cc-by", "public-domain"]


def test_license_odd_inputs(spark):
    assert len(licenses.op8_licenses(odd_docs(spark)).collect()) == 14
    assert licenses.op8_licenses(no_docs(spark)).collect() == []


# --- toxicity ---------------------------------------------------------------

def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in toxicity.op9_toxicity(docs, labels).collect() if r.held_out and r.doc_id in truth]
    toxic = [r.predicted for r in held if truth[r.doc_id]]
    clean = [r.predicted for r in held if not truth[r.doc_id]]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.01


def test_label_model_discounts_copies_and_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(2000) < 0.2
    good = np.where(truth, rng.random(2000) < 0.8, rng.random(2000) < 0.02)
    noise = rng.random(2000) < 0.3
    fires = np.stack([good] + [noise] * 6, axis=1)
    post = toxicity.label_model(fires, truth.astype(int))
    assert post[truth & good].mean() > 0.95 and post[~truth & ~good & noise].mean() < 0.1


def test_toxicity_odd_inputs(spark):
    labels = spark.createDataFrame([(1, 0, 1), (5, 0, 0), (None, 0, 1), (8, 1, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    assert len(toxicity.op9_toxicity(odd_docs(spark), labels).collect()) == 14
    none = labels.limit(0)
    rows = toxicity.op9_toxicity(spark.createDataFrame([row(1, "you idiot"), row(2, LONG), row(3, None)], SCHEMA), none).collect()
    assert {r.doc_id: r.predicted for r in rows} == {1: 1, 2: 0, 3: 0}
    assert toxicity.op9_toxicity(no_docs(spark), labels).collect() == []
