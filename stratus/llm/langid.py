"""Language identification of every text, and of its spans.

The script of a word's letters narrows the languages to those that use it; each
word then has a score per language, naive Bayes over its hashed letter
trigrams; Viterbi with a penalty for switching labels the words, so that a
text of several languages falls into spans. A text's language is the one that
its words together speak for most; its score is the mean of that language's
share of the words, by spans, and of the certainty of its lead.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and
no spans; words without a letter belong to the span around them; a text in a
script of no learned language gets the most common learned language with score
0; with nothing to learn from every text is ``und``; rows with repeated or null
ids are judged each by itself, and a null id is neither learned from nor held
out. Texts are judged whole: the time grows linearly with their words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import SMALL_SLICE_BYTES, Words, doc_bucket, mix64, text_slices, ship

#: Hash buckets of letter trigrams, hence the size of the model: languages x buckets.
BUCKETS = 1 << 15

#: Documents of each language that the model is fitted on, about (chosen by a hash of the id).
SAMPLE_PER_LANG = 3000

#: Nats that a switch of language costs; least score of a word against its best language.
SWITCH, FLOOR = 12.0, -6.0

#: Share of a language's letters from which a script counts as used by it.
SCRIPT_SHARE = 0.01

UNKNOWN = "und"

# First code points of Unicode script ranges, in order; 0 is "no letter of these".
SCRIPTS = ("none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "bengali", "thai",
           "georgian", "hangul", "kana", "han", "other")
RANGES = ((0x0000, "none"), (0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
          (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
          (0x0980, "bengali"), (0x0A00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
          (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x2C00, "other"), (0x3040, "kana"),
          (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
          (0xFB00, "other"))


@dataclass
class Model:
    langs: list[str]       # most common first
    scores: np.ndarray     # (BUCKETS, langs): log probability of a trigram
    scripts: np.ndarray    # (scripts, langs): whether the language uses the script


class Letters:
    """Trigrams and scripts of distinct words."""

    def __init__(self, vocab: list[str]):
        words = pc.utf8_lower(pc.ascii_trim(pa.array(vocab, pa.large_string()), characters="!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"))
        self.letters = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)
        size = pc.utf8_length(words).to_numpy() + 2
        text = "".join(["\x02" + w + "\x03" for w in words.to_pylist()])
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.ends = np.cumsum(size)
        # a trigram belongs to the word of its first character; those that cross words are left out
        n = max(len(c) - 2, 0)
        wide = c.astype(np.uint64)
        self.buckets = (mix64(wide[:n] | (wide[1:n + 1] << np.uint64(21)) | (wide[2:n + 2] << np.uint64(42))) % np.uint64(BUCKETS)).astype(np.int64)
        self.word = np.repeat(np.arange(len(vocab)), size)[:n]
        inside = np.arange(n) + 3 <= self.ends[self.word] if n else np.zeros(0, bool)
        self.buckets, self.word = self.buckets[inside], self.word[inside]
        starts, names = np.array([a for a, _ in RANGES]), np.array([SCRIPTS.index(s) for _, s in RANGES])
        of = names[np.searchsorted(starts, c, side="right") - 1]
        of[c < 0x41] = 0
        # the script of a word is that of its first letter of one
        first = np.flatnonzero(of > 0)
        owner = np.repeat(np.arange(len(vocab)), size)[first]
        self.script = np.zeros(len(vocab), np.int64)
        self.script[owner[::-1]] = of[first[::-1]]
        self.script[~self.letters] = 0

    def table(self, model: Model) -> np.ndarray:
        """(words, languages): scores against the best language, 0 for words without letters."""
        out = np.zeros((len(self.script), len(model.langs)), np.float32)
        count = np.bincount(self.word, minlength=len(out))
        for i in range(len(model.langs)):
            out[:, i] = np.bincount(self.word, weights=model.scores[self.buckets, i], minlength=len(out))
        out[count == 0] = 0
        able = model.scripts[self.script]
        some = able.any(axis=1)
        out = np.where(able, out, -np.inf)
        out[some] -= out[some].max(axis=1, keepdims=True)
        out[~some | ~self.letters] = 0
        return np.maximum(out, FLOOR).astype(np.float32)


def viterbi(table: np.ndarray, codes: np.ndarray, offsets: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word. All texts advance together, longest
    first, so a step is a few array operations over the texts still running."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    start, size = offsets[:-1][order], size[order]
    steps = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(steps), side="left")  # texts with more than t words
    langs = table.shape[1]
    back = np.empty((len(codes), langs), np.int8)
    own = np.arange(langs, dtype=np.int8)
    total = np.zeros((len(size), langs), np.float32)
    for t in range(steps):
        n = running[t]
        at, now = start[:n] + t, total[:n]
        best = now.argmax(axis=1)
        least = now[np.arange(n), best][:, None] - np.float32(switch)
        stays = now >= least
        back[at] = np.where(stays, own, best[:, None])
        total[:n] = np.where(stays, now, least) + table[codes[at]]
    labels = np.empty(len(codes), np.int8)
    state = total.argmax(axis=1).astype(np.int8)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        at = start[:n] + t
        labels[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return labels


def judge(texts: pa.Array, model: Model):
    """(language per text, score per text, spans as a list array)."""
    words = Words(texts)
    n = len(texts)
    span_type = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])
    if not model.langs or not len(words.codes):
        return [UNKNOWN] * n, np.zeros(n), pa.array([[]] * n, pa.list_(span_type))
    letters = Letters(words.vocab)
    table = letters.table(model)
    labels = viterbi(table, words.codes, words.offsets)
    doc = np.repeat(np.arange(n), np.diff(words.offsets))
    real = letters.letters[words.codes]
    langs = len(model.langs)
    votes = np.bincount(doc[real] * langs + labels[real], minlength=n * langs).reshape(n, langs)
    sums = np.stack([np.bincount(doc, weights=table[words.codes, i], minlength=n) for i in range(langs)], axis=1)
    some = votes.sum(axis=1)
    best = sums.argmax(axis=1)
    told = np.bincount(doc, weights=(table.max(axis=1) > table.min(axis=1))[words.codes] if langs > 1 else real, minlength=n) > 0
    ranked = np.sort(sums, axis=1)
    margin = ranked[:, -1] - ranked[:, -2] if langs > 1 else np.full(n, np.inf)
    share = votes[np.arange(n), best] / np.maximum(some, 1)
    score = np.where((some > 0) & told, (share + 1 - np.exp(-margin)) / 2, 0.0)
    lang = [model.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
    # spans: where the label or the text changes
    new = np.concatenate([[True], (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    stop = np.append(first[1:], len(labels))
    base = words.offsets[doc[first]]
    rows = pa.StructArray.from_arrays(
        [pa.array((first - base).astype(np.int32)), pa.array((stop - base).astype(np.int32)),
         pa.array(np.array(model.langs, dtype=object)[labels[first]], pa.string())], fields=list(span_type))
    per_doc = np.bincount(doc[first], minlength=n)
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)), rows)
    return lang, score, spans


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on at most about ``per_lang`` documents of each language, chosen by a
    hash of the id; counts are summed in Spark, and what reaches the driver is
    one row per language and bucket."""
    ship(docs.sparkSession)
    able = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in able.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool))
    langs = sorted(sizes, key=lambda x: (-sizes[x], x))
    share = F.create_map(*(v for x in langs for v in (F.lit(x), F.lit(min(1.0, per_lang / sizes[x])))))
    chosen = able.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def count(batches):
        counts = {}
        for batch in text_slices(batches, limit=SMALL_SLICE_BYTES):
            words = Words(batch.column("text"))
            if not len(words.codes):
                continue
            letters = Letters(words.vocab)
            lang = batch.column("lang").to_numpy(zero_copy_only=False)
            of = np.repeat(lang, np.diff(words.offsets))
            for x in set(lang):
                n = np.bincount(words.codes[of == x], minlength=len(words.vocab))
                own = counts.setdefault(x, np.zeros(BUCKETS + len(SCRIPTS)))
                own[:BUCKETS] += np.bincount(letters.buckets, weights=n[letters.word], minlength=BUCKETS)
                own[BUCKETS:] += np.bincount(letters.script, weights=n, minlength=len(SCRIPTS))
        for x, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.record_batch([pa.array([x] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "bucket", "n"])

    rows = chosen.select("text", "lang").mapInArrow(count, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
    column = {x: i for i, x in enumerate(langs)}
    n[rows["bucket"].to_numpy(), [column[x] for x in rows["lang"].to_pylist()]] = rows["n"].to_numpy()
    grams, scripts = n[:BUCKETS] + 0.5, n[BUCKETS:]
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts[1:].sum(axis=0), 1)
    used[0] = True
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), used)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every document, from its text alone."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS

    def run(batches):
        for batch in text_slices(batches, limit=SMALL_SLICE_BYTES):
            lang, score, spans = judge(batch.column("text"), model.value)
            yield pa.record_batch([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), spans],
                                  names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least``."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in text_slices(batches, limit=SMALL_SLICE_BYTES):
            lang, score, _ = judge(batch.column("text"), model.value)
            yield batch.filter(pa.array([x != UNKNOWN for x in lang]) if least <= 0 else pa.array((score >= least) & (np.array(lang) != UNKNOWN)))

    return docs.mapInArrow(run, docs.schema)


def op5_langid(docs: DataFrame) -> DataFrame:
    learn = docs.where(doc_bucket(F.col("doc_id"), 5) != 0)
    return (identify(docs, train(learn))
            .select("doc_id", F.coalesce(doc_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score",
                    F.size("spans").alias("n_spans")))
