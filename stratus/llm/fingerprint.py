"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its units: its paragraphs (lines), cut at the blanks
that follow certain characters, so that the cuts depend on the text around them
alone and a paragraph changed in one place keeps its other units. Every unit hashes to a wide
vector of signs; the fingerprint is the vectors' sum, each lane modulo 2**32.
So the order of units is without effect, and a unit is inserted or deleted by
adding or subtracting its vector, without looking at the rest of the text. As
lanes are sums of random signs, products of two fingerprints estimate how many
units two texts share.

Edge cases: a null text counts as empty, and an empty text is one empty unit;
a null doc_id sorts last; rows that repeat a doc_id are ordered by text; the
only document of a table is its own next; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import ship, shuffle_partitions, text_slices

LANES = 128
#: A blank behind one of these ends a unit: every few words, in any language with blanks.
CUT = re.compile(r"(?<=[.!?,;:nsr]) ")


def units(text: str) -> list[bytes]:
    data = [u for line in text.split("\n") for u in CUT.split(line)]
    return [u.encode("utf-8", "surrogatepass") for u in data]


def vector(parts: list[bytes]) -> np.ndarray:
    """Sum of the units' vectors, modulo 2**32."""
    digest = b"".join([hashlib.blake2b(u, digest_size=LANES // 8).digest() for u in parts])
    bits = np.unpackbits(np.frombuffer(digest, np.uint8).reshape(-1, LANES // 8), axis=1)
    return (2 * bits.sum(axis=0, dtype=np.int64) - len(parts)).astype(np.int32)


def insert(fingerprint: np.ndarray, text: str) -> np.ndarray:
    """The fingerprint with the units of ``text`` added."""
    return fingerprint + vector(units(text))


def delete(fingerprint: np.ndarray, text: str) -> np.ndarray:
    return fingerprint - vector(units(text))


def encoded(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<i4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """2ab / (aa + bb): 1 for equal multisets, about 0 without a common unit."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    whole = x @ x + y @ y
    return 1.0 if not whole else min(1.0, max(0.0, 2 * float(x @ y) / whole))


def replace_tail(fingerprint: np.ndarray, text: str, at: int, tail: str) -> np.ndarray:
    """The fingerprint of text[:at] + tail: only units from the line of ``at`` on are hashed."""
    line = text.rfind("\n", 0, at) + 1
    return insert(delete(fingerprint, text[line:]), text[line:at] + tail)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, guest, doc_id, text) such that the documents of a bucket,
    by descending id, are followed by a copy of the next bucket's first one
    (``guest``; behind the last bucket, of the first).

    Buckets are ranges of ids between quantiles; what the driver learns is one
    id per bucket, and their number is four per shuffle partition.
    """
    spark = docs.sparkSession
    n = 4 * shuffle_partitions(spark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", F.coalesce("doc_id", F.lit(-2**63)))
    quantiles = keyed.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n)).first()[0]
    points = F.array(*(F.lit(p).cast("long") for p in sorted(set(quantiles or [])))).cast("array<long>")
    keyed = keyed.withColumn("bucket", F.size(F.filter(points, lambda p: p < F.col("key"))))
    heads = sorted(((r[0], r[1]) for r in keyed.groupBy("bucket").agg(F.max("key")).collect()), reverse=True)
    guests = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]  # heads[-1]: behind the last comes the first
    guests = spark.createDataFrame(guests, "head long, host int")
    both = F.filter(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
                            F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest"))), lambda x: x["bucket"].isNotNull())
    return (keyed.join(F.broadcast(guests), F.col("key") == F.col("head"), "left")
            .withColumn("to", F.explode(both))
            .select("to.bucket", "to.guest", "doc_id", "key", "text"))


def op4_fingerprint(docs: DataFrame) -> DataFrame:
    """The contract's rows; the edited text's fingerprint is updated from the
    text's own, not computed anew."""
    def run(batches):
        last = None  # (bucket, doc_id, text, fingerprint) that waits for its next document
        for batch in text_slices(batches):
            rows = []
            for bucket, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True):
                if guest and (last is None or last[0] != bucket):
                    continue
                now = vector(units(text))
                if last is not None and last[0] == bucket:
                    _, own_id, own, fingerprint = last
                    n = len(own)
                    cut = n // 3
                    at, tail = n - cut, text[:cut]
                    edited = replace_tail(fingerprint, own, at, tail)
                    digest = hashlib.sha256((own[:at] + tail).encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((own_id, n, digest, encoded(fingerprint), encoded(edited), likeness(fingerprint, edited), likeness(fingerprint, now)))
                last = None if guest else (bucket, doc_id, text, now)
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)],
                                      names=[c.split()[0] for c in SCHEMA.split(", ")])

    ship(docs.sparkSession)
    rows = in_order(docs)
    return (rows.repartition(shuffle_partitions(docs.sparkSession), "bucket")
            .sortWithinPartitions("bucket", "guest", F.desc("key"), "text")
            .drop("key").mapInArrow(run, SCHEMA))


TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
