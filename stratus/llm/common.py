"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stratus
from stratus.session import cut_lineage

#: Java pattern of one word of the contracts: no blank and no ASCII control blank.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a Python task works on at once; fewer where the work takes many times the text.
SLICE_BYTES = 8 << 20
SMALL_SLICE_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context, so
    that they need no copy of the repository on their path."""
    context = spark.sparkContext
    if getattr(context, "_stratus_shipped", False):
        return
    root = Path(stratus.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="stratus-ship-"), "stratus.zip")  # the driver serves it from here
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, Path("stratus", file.relative_to(root)))
    context.addPyFile(str(path))
    context._stratus_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    ship(df.sparkSession)
    return cut_lineage(df, f"llm-{name}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """A-Z to lower case; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def doc_bucket(doc_id, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def text_slices(batches, column: str = "text", limit: int | None = None):
    """Cut record batches so that each part holds about ``limit`` bytes of text
    (one longer text is a part of its own); SLICE_BYTES where none is given."""
    limit = SLICE_BYTES if limit is None else limit
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            # a copy: some of pyarrow's string functions misread slices
            yield batch if to - at == batch.num_rows else batch.take(pa.array(np.arange(at, to)))
            at = to
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


class Words:
    """Lower-cased words of many texts as codes into one vocabulary.

    ``codes[offsets[i]:offsets[i + 1]]`` are the words of text ``i``;
    ``vocab`` holds each distinct word once. A null text has no words. Words
    are runs without blanks (space, tab to carriage return); only A-Z change.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        if texts.offset:  # some of pyarrow's string functions misread slices
            texts = texts.take(pa.array(np.arange(len(texts))))
        texts = texts.cast(pa.large_string()).fill_null("")
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        coded = parts.values.dictionary_encode()
        ends = parts.offsets.to_numpy()
        vocab = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        empty = vocab.index("") if "" in vocab else -1
        if empty >= 0:  # leading and trailing blanks leave empty strings
            real = codes != empty
            ends = np.concatenate([[0], np.cumsum(real)])[ends]
            codes = codes[real]
        self.codes, self.vocab, self.offsets = codes, vocab, ends.astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, in text order."""
        of = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.vocab), np.uint64, len(self.vocab))
        return of[self.codes] if len(self.codes) else np.zeros(0, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit integers (the public murmur3 constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of k words within one text, and their first word's index."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = mix64(h ^ words[i:i + n]) + np.uint64(0x9E3779B97F4A7C15)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    at = np.flatnonzero(np.arange(n) + k <= ends)
    return h[at], at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the
    smallest node of the component.

    Alternates "large star" and "small star" steps: every step points a node's
    neighbours at the smallest of them, so the number of rounds grows with the
    logarithm of the longest path. Each round is stored in the shared folder.
    """
    def mark(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    def small_star(e: DataFrame) -> DataFrame:
        """Each node's smaller neighbours, and itself, at the smallest of them."""
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        return (e.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                .distinct())

    pointed = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = store(small_star(pointed), "edges")  # first of all: it makes one edge of many for nodes of several stars
    before = mark(current)
    if not before[0]:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # edges point from larger to smaller nodes: a node's larger neighbours are the edges that point at it
        large = current.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")).distinct()
        small = small_star(large)
        current = store(small, "edges")
        now = mark(current)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
