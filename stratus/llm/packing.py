"""Best-fit decreasing packing of tokenized documents into fixed sequences.

Best-fit decreasing only looks at lengths, and a length lies between 1 and the
capacity. So the whole corpus is packed exactly as one list, from its histogram
of lengths: every open sequence of the same free space is alike, a segment tree
over free spaces finds the tightest that takes the next length, and as many
documents as fit are placed at once. The histogram and the plan are bounded by
the capacity, whatever the corpus. The pieces then find their places by their
rank among the pieces of their length: ranks come from counts per hash bucket,
so a length that holds a third of all pieces is spread over many tasks.

Edge cases: a null or empty text is its end token alone; rows that repeat a
doc_id are separate documents; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import Words, store, text_slices

#: Bytes of words and ids that a Python worker remembers before it starts anew (speed only); an entry counts for ENTRY_BYTES more.
REMEMBERED_BYTES, ENTRY_BYTES = 64 << 20, 150

#: Pieces whose rank one window orders, about.
ROWS_PER_BUCKET = 2000

#: ASCII punctuation: behind a word of letters it is one pre-token by itself.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder:
    """Token ids of texts, encoding each distinct white-space separated word once.

    Exact for tokenizers whose pre-tokenizer drops white space, whose
    normaliser lower-cases and which part letters from punctuation: no
    pre-token then spans a blank, so a text's ids are its words' ids in order,
    and a word of letters with punctuation behind it is those two in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.reset()

    def reset(self):
        self.known, self.starts, self.ids = {"": 0}, array("q", [0, 0]), array("I")
        self.held = 0

    def add(self, part: str, ids: list[int]):
        self.known[part] = len(self.starts) - 1
        self.held += len(part) + ENTRY_BYTES
        self.ids.extend(ids)
        self.starts.append(len(self.ids))

    def learn(self, parts: list[str]):
        """Encode parts that are not known yet."""
        merges, whole = self.tokenizer.model.tokenize, []
        for part in parts:
            if part.isascii() and part.isalpha():  # one pre-token, lower case: the merges alone
                self.add(part, [t.id for t in merges(part)])
            else:
                whole.append(part)
        for at in range(0, len(whole), 64):
            some = whole[at:at + 64]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = e.ids
            first = np.cumsum([0] + [len(w) + 1 for w in some])
            of = np.searchsorted(first, np.array([o[0] for o in e.offsets], dtype=np.int64), side="right") - 1
            ends = np.cumsum(np.bincount(of, minlength=len(some))).tolist()
            i = 0
            for part, j in zip(some, ends, strict=True):
                self.add(part, ids[i:j])
                i = j

    def rows(self, parts: pa.Array) -> np.ndarray:
        """The known rows of an array of parts."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn([w for w in distinct if w not in self.known])
        known = self.known
        return np.fromiter((known[w] for w in distinct), np.int64, len(distinct))[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text begins, with the end)."""
        words = Words(texts)
        if self.held + 4 * len(self.ids) > REMEMBERED_BYTES:
            self.reset()
        if not len(words.codes):
            return np.zeros(0, np.uint32), np.zeros(len(words.offsets), np.int64)
        vocab = pa.array(words.vocab, pa.large_string())
        core = pc.ascii_rtrim(vocab, characters=PUNCTUATION)
        plain = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring(core, "\u0130")))  # whose lower case is no letter
        core = pc.if_else(plain, core, vocab)
        tail = pa.array([w[len(c):] for w, c in zip(words.vocab, core.to_pylist(), strict=True)], pa.large_string())
        head, rest = self.rows(core), self.rows(tail)
        starts, ids = np.array(self.starts), np.array(self.ids, dtype=np.uint32)
        size = np.diff(starts)
        both = np.stack([head, rest], axis=1)[words.codes].ravel()
        n = size[both]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(starts[both] - ends[:-1], n) + np.arange(ends[-1])
        return ids[at], ends[2 * words.offsets]


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)


class BestFitTree:
    """Counts of open sequences by free space; finds the least space >= need.

    A segment tree: node i holds whether any leaf below it has a sequence.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.size)

    def set(self, space: int, count: int):
        i = space + self.size
        self.any[i] = count
        i >>= 1
        while i:
            self.any[i] = self.any[2 * i] + self.any[2 * i + 1]
            i >>= 1

    def tightest(self, need: int) -> int:
        """-1 if no open sequence has ``need`` left."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def plan_packing(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over a histogram of lengths.

    Rows (length, first rank, count, first sequence, offset): pieces of that
    length with ranks first .. first + count - 1 go to the sequences from
    ``first sequence`` on, one each, at ``offset``.
    """
    tree, spaces = BestFitTree(capacity), {}  # free space -> runs (first sequence, count)
    rows, opened = [], 0

    def put(space: int, first: int, count: int):
        if space and count:
            spaces.setdefault(space, []).append((first, count))
            tree.set(space, tree.any[space + tree.size] + count)

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            space = tree.tightest(length)
            if space >= 0:
                first, count = spaces[space].pop()
                m = min(count, left)
                tree.set(space, tree.any[space + tree.size] - count)
                put(space, first + m, count - m)
                rows.append((length, rank, m, first, capacity - space))
                put(space - length, first, m)
            else:
                # No open sequence takes this length. A new one is the only fit
                # until it is full, so each takes as many of the length as it can.
                each = capacity // length
                m = max(1, left // each) if left >= each else 1
                fill = min(each, left)
                for j in range(fill):
                    rows.append((length, rank + j * m, m, opened, j * length))
                put(capacity - fill * length, opened, m)
                opened += m
                m *= fill
            rank += m
            left -= m
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    def run(batches):
        encoder = encoder_of(tokenizer)
        for batch in text_slices(batches):
            ids, at = encoder.encode(batch.column("text"))
            doc, piece, start, length, crc = [], [], [], [], []
            for d, a, b in zip(batch.column("doc_id").to_pylist(), at[:-1], at[1:], strict=True):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                for p, s in enumerate(range(0, len(own), capacity)):
                    cut = own[s:s + capacity]
                    doc.append(d)
                    piece.append(p)
                    start.append(s)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
            yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents; per piece its place (sequence_id, offset)."""
    spark = docs.sparkSession
    pieces = store(pieces_of(docs, tokenizer or tokenizer_path(), capacity, end_id), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(plan_packing(histogram, capacity))  # bounded by the capacity

    buckets = max(1, min(65536, -(-sum(histogram.values()) // ROWS_PER_BUCKET)))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (pieces.groupBy("length", "bucket").count()
              .select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("own", F.row_number().over(within) - 1)
              .join(starts, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).alias("rank")))

    def place(batches):
        rows = plan.value
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        lengths = rows[:, 0]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            lo, hi = np.searchsorted(lengths, length), np.searchsorted(lengths, length, side="right")
            while (wide := hi - lo > 1).any():  # the last row of the length that starts at or before the rank
                mid = (lo + hi) // 2
                up = rows[np.minimum(mid, len(rows) - 1), 1] <= rank
                lo, hi = np.where(wide & up, mid, lo), np.where(wide & ~up, mid, hi)
            at = rows[lo]
            yield pa.record_batch([batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                                  + [pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op2_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
