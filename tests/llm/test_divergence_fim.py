import collections
import hashlib
import random
import re
from fractions import Fraction
from math import floor

import numpy as np

from stratus.llm import fill_middle
from stratus.llm.divergence import op12_divergence
from stratus.llm.fill_middle import BoundarySet, boundaries, fill_middle as fim, op13_fill_middle, restore
from tests.llm.helpers import SCHEMA, no_docs, odd_docs, prose, rng, row

# --- fill in the middle --------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(doc_id, text):
    text = text or ""
    tokens = UNITS.findall(text)
    n = len(tokens)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def test_boundary_sets_of_every_container():
    r = np.random.default_rng(3)
    span = fill_middle.SPAN
    sets = [np.array([], np.int64), np.array([0]), np.arange(5), np.arange(1, 3 * span), np.arange(0, 2 * span, 2),
            np.sort(r.choice(4 * span, 3000, replace=False)), np.sort(r.choice(3 * span, 60_000, replace=False)),
            np.concatenate([np.arange(10, 9000), span + np.arange(0, 20_000, 3), [5 * span, 5 * span + 7]])]
    seen = set()
    for offsets in sets:
        own = BoundarySet(offsets.astype(np.int64))
        assert len(own) == len(offsets)
        seen |= {type(c).__name__ for c in own.containers}
        for i in {0, len(offsets) - 1, *r.integers(0, max(1, len(offsets)), 200).tolist()} if len(offsets) else ():
            assert own.select(i) == offsets[i]
    assert seen == {"ArrayContainer", "BitmapContainer", "RunContainer"}


def test_boundaries_are_the_units_ends():
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice("ab é日😀 \t\n\r\x0b\x1c  ") for _ in range(r.randint(0, 40)))
        ends = [m.end() for m in UNITS.finditer(text)]
        own = boundaries(text)
        assert [own.select(i) for i in range(len(own))] == ends


def test_fim_of_odd_and_long_documents(spark):
    long_text = " ".join(f"w{i}" for i in range(200_000))
    docs = odd_docs(spark).union(spark.createDataFrame(
        [row(i, f"  some words {i}\tand\nmore " * (i % 7)) for i in range(100, 300)]
        + [row(400, "a <M> b c d"), row(401, long_text), row(402, long_text), row(403, long_text), row(404, " \n "), row(405, " \n ")], SCHEMA))
    want = sorted((plain_fim(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    got = sorted((tuple(r) for r in op13_fill_middle(docs).collect()), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    assert op13_fill_middle(no_docs(spark)).collect() == []


def test_fim_keeps_columns_and_restores(spark):
    docs = odd_docs(spark)
    out = fim(docs, fill_middle.Rates(cut=100, spm=30))
    assert out.columns[:len(docs.columns)] == docs.columns
    for r in out.collect():
        assert restore(r.fim_output, r.fim_form) == (r.text or "")
        assert r.fim_form == "plain" or r.text[:r.fim_prefix_chars] == r.fim_output.split("<P>")[1].split("<S>")[0].split("<M>")[0]


# --- divergence --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_divergence(rows, least=10):
    groups, docs_of = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(terms)
        docs_of[lang or ""].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in docs_of.items()}
    whole = collections.defaultdict(collections.Counter)
    for (lang, _), c in groups.items():
        whole[lang].update(c)

    def p(counter, lang, t):
        total = sum(n for u, n in counter.items() if u in kept[lang])
        return 1 + floor(Fraction(10**9 * (counter[t] + 2), total + 2 * len(kept[lang])))

    out = []
    for (lang, source), c in groups.items():
        mine = {t: p(c, lang, t) for t in kept[lang]}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        pairs = [(sum(f(mine[t], p(d, lang, t)) for t in kept[lang]), other) for (l2, other), d in groups.items() if l2 == lang and other != source]
        terms = [(f(mine[t], p(whole[lang], lang, t)), t) for t in kept[lang] if c[t] > 0 and mine[t] > p(whole[lang], lang, t)]
        for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def check_divergence(docs, **options):
    got = [tuple(r) for r in op12_divergence(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert sorted(got) == plain_divergence([(r.text, r.lang, r.source) for r in docs.collect()])
    return got


def test_divergence_against_plain_counts(spark):
    r = rng(8)
    words = ["".join(r.choice("abcdé日") for _ in range(r.randint(1, 3))) for _ in range(60)] + ["Ünï", "AbC", "x1y", "o'k", "ſK"]
    rows = []
    for i in range(400):
        lang, source = r.choice(["en", "fr", None]), r.choice(["a", "b", "c", "日", "é", None, "a" if i % 3 else "hot"])
        own = words[len(source or "") * 7:] if r.random() < 0.5 else words
        rows.append(row(i, " ".join(r.choice(own) for _ in range(r.randint(0, 30))), lang, source))
    got = check_divergence(spark.createDataFrame(rows, SCHEMA))
    assert {x[2] for x in got} == {"pair", "term"} and max(x[5] for x in got if x[2] == "term") == 10


def test_divergence_ties_and_blocks(spark):
    # all counts tie, so that one cell holds every term; several blocks of sources
    text = " ".join(f"{a}{b}" for a in "zyxé" for b in "qrst")
    rows = [row(i, text if i % 8 else "zq zq", "en", f"s{i % 8}") for i in range(160)] + [row(500, "alone", "de", "one"), row(501, None, "en", "none")]
    got = check_divergence(spark.createDataFrame(rows, SCHEMA), sources=3)
    assert len([x for x in got if x[1] == "s1" and x[2] == "term"]) == 10


def test_divergence_odd_inputs(spark):
    check_divergence(odd_docs(spark))
    docs = odd_docs(spark)
    for _ in range(4):
        docs = docs.union(docs)
    check_divergence(docs)
    assert op12_divergence(no_docs(spark)).collect() == []
