"""Toxicity scores by weak supervision.

Many voters look at a text: words and word beginnings mined from a bounded
sample of labelled documents, hand-written lexicons and patterns, and the
absence of any hit. A generative label model treats the true class as hidden:
expectation maximisation estimates how often each voter fires in either class,
and the correlations between voters within a class discount those that repeat
each other. Its posterior labels train a linear classifier over the voters,
which scores every text.

Edge cases: a null or empty text has no hit and gets the score of such a text;
labels without a toxic value or for unknown documents are not used, and an id
labelled more than once counts as toxic if one of its labels says so; a null id is
neither learned from nor held out; rows that repeat a doc_id are scored each;
without a positive and a negative label the hand-written voters decide with
fixed weights; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import Words, doc_bucket, ship, text_slices

#: Labelled documents that the model is fitted on, about (chosen by a hash of the id).
LABELLED = 20_000
#: Mined voters at most; toxic documents that a mined voter needs; its least share of toxic ones.
MINED, SUPPORT, PRECISION = 300, 3, 0.6
#: Lengths of word beginnings; longest whole word that is mined.
PREFIXES, LONGEST = (4, 5, 6, 7, 8), 14
PREDICT = 0.7

# Hand-written lexicons (lower case), one voter each.
LEXICONS = {
    "insult": ("idiot", "moron", "stupid", "imbecile", "dumb", "fool", "loser", "clown", "jerk", "dimwit", "halfwit"),
    "contempt": ("pathetic", "worthless", "disgusting", "trash", "scum", "garbage", "filth", "vermin", "ugly", "useless"),
    "hate": ("hate", "despise", "loathe", "detest"),
    "threat": ("kill", "murder", "hurt", "destroy", "die"),
    "insult_de": ("idiot", "dumm", "blöd", "trottel", "arschloch", "abschaum", "versager"),
    "insult_fr": ("idiot", "imbécile", "stupide", "connard", "salaud", "débile", "crétin"),
    "insult_es": ("idiota", "estúpido", "imbécil", "basura", "asqueroso", "inútil", "tonto"),
}
#: Hand-written patterns on the whole text.
PATTERNS = {
    "you_are": r"(?i)\byou(?:'re| are) (?:a |an |such |so )",
    "shut_up": r"(?i)\bshut up\b|\bget lost\b|\bgo away\b",
    "shouting": r"(?:\b[A-Z]{3,}[!.,]* ){4}",
    "exclaims": r"!{2,}",
}
ABSENT = "no mined or lexicon voter"


@dataclass
class Model:
    words: list[str]                # mined whole words
    prefixes: dict[int, list[str]]  # mined word beginnings by length
    weight: np.ndarray              # of each voter, in the order of `names`
    bias: float

    def names(self) -> list[str]:
        return self.words + [p for n in PREFIXES for p in self.prefixes[n]] + list(LEXICONS) + list(PATTERNS) + [ABSENT]


def plain(vocab: list[str]) -> pa.Array:
    return pc.utf8_lower(pc.ascii_trim(pa.array(vocab, pa.large_string()), characters="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))


def beginning(words: pa.Array, size: int) -> pa.Array:
    """The first ``size`` letters of longer words; empty for others."""
    return pc.if_else(pc.greater(pc.utf8_length(words), size), pc.utf8_slice_codeunits(words, 0, size), "")


def votes(texts: pa.Array, words: list[str], prefixes: dict[int, list[str]]) -> np.ndarray:
    """(texts, voters) of booleans: which voters fire."""
    found = Words(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(found.offsets))
    vocab = plain(found.vocab)
    out = []

    def lookup(values: pa.Array, entries: list[str], columns: list[int], width: int):
        hit = np.zeros((n, width), bool)
        if entries and len(doc):
            at = pc.index_in(values, value_set=pa.array(entries, values.type)).fill_null(-1).to_numpy(zero_copy_only=False)
            of = at[found.codes]
            real = of >= 0
            hit[doc[real], np.array(columns)[of[real]]] = True
        return hit

    out.append(lookup(vocab, words, list(range(len(words))), len(words)))
    for size in PREFIXES:
        own = prefixes[size]
        out.append(lookup(beginning(vocab, size), own, list(range(len(own))), len(own)))
    for lexicon in LEXICONS.values():
        out.append(lookup(vocab, list(lexicon), [0] * len(lexicon), 1))
    whole = texts.fill_null("")
    for pattern in PATTERNS.values():
        out.append(pc.match_substring_regex(whole, pattern).to_numpy(zero_copy_only=False)[:, None])
    lexical = np.concatenate(out[:-len(PATTERNS)], axis=1)
    return np.concatenate(out + [~lexical.any(axis=1)[:, None]], axis=1)


def mine(sample: DataFrame, positives: int, negatives: int) -> tuple[list[str], dict[int, list[str]]]:
    """Words and word beginnings that mark toxic documents of the sample: the
    MINED with the largest likelihood ratio. Counted in Spark."""
    def count(batches):
        for batch in text_slices(batches):
            found = Words(batch.column("text"))
            n = batch.num_rows
            doc = np.repeat(np.arange(n), np.diff(found.offsets))
            toxic = batch.column("toxic").to_numpy()
            vocab = plain(found.vocab)
            length = pc.utf8_length(vocab).to_numpy()
            for size in (0, *PREFIXES):
                coded = (beginning(vocab, size) if size else vocab).dictionary_encode()
                of = coded.indices.to_numpy()[found.codes]
                fits = (length > size if size else (length > 0) & (length <= LONGEST))[found.codes]
                pairs = np.unique(doc[fits] * np.int64(len(coded.dictionary)) + of[fits])
                d, f = np.divmod(pairs, np.int64(max(1, len(coded.dictionary))))
                bad = np.bincount(f, weights=toxic[d], minlength=len(coded.dictionary)).astype(np.int64)
                total = np.bincount(f, minlength=len(coded.dictionary))
                at = np.flatnonzero(total)
                yield pa.record_batch([pa.array([size] * len(at), pa.int32()), coded.dictionary.cast(pa.string()).take(pa.array(at)),
                                       pa.array(bad[at]), pa.array((total - bad)[at])], names=["size", "entry", "bad", "good"])

    ship(sample.sparkSession)
    rows = (sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(count, "size int, entry string, bad long, good long")
            .groupBy("size", "entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .where((F.col("bad") >= SUPPORT)))
    p, q = (F.col("bad") + 0.5) / (positives + 1), (F.col("good") + 0.5) / (negatives + 1)
    rows = (rows.where(p / (p + q) >= PRECISION).where(F.col("bad") / (F.col("bad") + F.col("good")) >= PRECISION)
            .orderBy(F.desc(F.col("bad") * F.log(p / q)), "size", "entry").limit(MINED).collect())  # at most MINED rows
    return [r.entry for r in rows if r.size == 0], {n: [r.entry for r in rows if r.size == n] for n in PREFIXES}


def label_model(fires: np.ndarray, labels: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Posterior probability of the toxic class for each row.

    Each voter j fires with rate a[j] in toxic and b[j] in clean texts. The
    given label is one more voter, of high but not perfect accuracy. Voters
    whose residuals within the classes are correlated share their weight: a
    voter's log odds are divided by the sum of its squared correlations, itself
    included, so m copies of one voter weigh as one.
    """
    x = fires.astype(np.float64)
    post = np.where(labels > 0, 0.95, 0.05)
    for _ in range(rounds):
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        a = (post @ x + 0.5) / (post.sum() + 1)
        b = ((1 - post) @ x + 0.5) / ((1 - post).sum() + 1)
        rest = x - (post[:, None] * a + (1 - post)[:, None] * b)
        spread = np.sqrt((rest ** 2).sum(axis=0)) + 1e-9
        alike = (rest.T @ rest) / np.outer(spread, spread)
        share = 1 / np.maximum((alike ** 2).sum(axis=1), 1)
        on, off = np.log(a / b) * share, np.log((1 - a) / (1 - b)) * share
        odds = np.log(prior / (1 - prior)) + x @ on + (1 - x) @ off + np.where(labels > 0, 1, -1) * np.log(0.95 / 0.05)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post


def fit_linear(fires: np.ndarray, target: np.ndarray, l2: float = 1e-5, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    x = np.concatenate([fires.astype(np.float64), np.ones((len(fires), 1))], axis=1)
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), l2 * len(x))
    ridge[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (target - p) - ridge * w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    """Fit on at most about ``bound`` labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = known.count()
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * min(1.0, bound / max(total, 1)))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ids and labels of about `bound` rows
    counts = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    bad, good = sum(n for t, n in counts.items() if t > 0), sum(n for t, n in counts.items() if t <= 0)
    if not bad or not good:
        empty = Model([], {n: [] for n in PREFIXES}, np.zeros(0), -3.0)
        empty.weight = np.array([5.0 if n in ("insult", "contempt") or n.startswith("insult_") else 1.0 if n != ABSENT else -1.0 for n in empty.names()])
        return empty
    words, prefixes = mine(sample, bad, good)

    def fire(batches):
        for batch in text_slices(batches):
            packed = np.packbits(votes(batch.column("text"), words, prefixes), axis=1)
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), pa.array([r.tobytes() for r in packed], pa.binary())], names=["doc_id", "toxic", "fires"])

    # about `bound` rows of a few dozen bytes each; sorted, so that reruns agree
    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic"), "text").mapInArrow(fire, "doc_id long, toxic int, fires binary").toArrow().sort_by("doc_id")
    model = Model(words, prefixes, np.zeros(0), 0.0)
    n = len(model.names())
    fires = np.unpackbits(np.frombuffer(b"".join(rows["fires"].to_pylist()), np.uint8).reshape(len(rows), -1), axis=1)[:, :n].astype(bool)
    post = label_model(fires, rows["toxic"].to_numpy())
    model.weight, model.bias = fit_linear(fires, post)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document, from its text alone."""
    model = docs.sparkSession.sparkContext.broadcast(model)  # at most MINED entries

    def run(batches):
        for batch in text_slices(batches):
            m = model.value
            x = votes(batch.column("text"), m.words, m.prefixes) @ m.weight + m.bias
            yield pa.record_batch([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op9_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    learn = labels.where(doc_bucket(F.col("doc_id"), 3) != 1)
    return (score(docs, train(docs, learn))
            .select("doc_id", F.coalesce(doc_bucket(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= PREDICT).cast("int").alias("predicted")))
