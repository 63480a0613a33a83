"""Fill-in-the-middle documents, cut at boundaries of units.

A text is cut into units (blanks and the word behind them; blanks at the end
are a unit of their own). The code point offsets at which units end form a
*boundary set*, kept as compressed containers of 2**16 offsets each: a sorted
array, a bitmap or a list of runs, whichever is smallest. Containers have
cumulative cardinalities, so the offset behind the k-th unit is found by a
binary search over containers and a select inside one of them, whatever the
length of the text.

Edge cases: a null text counts as empty (form ``plain``, no units); a null
doc_id is drawn for as the empty string; rows that repeat a doc_id each give a
row, with the same draws; a text that contains a marker stays plain; an empty
table gives an empty result; further columns are ignored by the query and kept
by :func:`fill_middle`.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import ship, text_slices

#: Offsets of one container.
SPAN = 1 << 16
#: Most entries of an array container: beyond, a bitmap of 8 kB is smaller.
ARRAY_MAX = 4096

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)


class ArrayContainer:
    """Sorted offsets, two bytes each."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.low)

    def select(self, i: int) -> int:
        return int(self.low[i])


class BitmapContainer:
    """One bit per offset, with the cardinality in front of every word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self.bits = np.packbits(bits.reshape(-1, 64), axis=1, bitorder="little")
        self.before = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(axis=1, dtype=np.int64))])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, i: int) -> int:
        word = int(np.searchsorted(self.before, i, side="right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[word], bitorder="little"))
        return 64 * word + int(inside[i - self.before[word]])


class RunContainer:
    """Runs of consecutive offsets: starts and the cardinality before each."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(lengths)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, i: int) -> int:
        run = int(np.searchsorted(self.before, i, side="right")) - 1
        return int(self.starts[run]) + i - int(self.before[run])


def container(low: np.ndarray):
    """The smallest container of sorted distinct offsets below SPAN."""
    heads = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    array_bytes = 2 * len(low) if len(low) <= ARRAY_MAX else SPAN
    if 4 * len(heads) < min(array_bytes, SPAN // 8):
        return RunContainer(low[heads], np.diff(np.append(heads, len(low))))
    return ArrayContainer(low) if len(low) <= ARRAY_MAX else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct offsets with select in logarithmic time."""

    def __init__(self, offsets: np.ndarray):
        high = offsets // SPAN
        cuts = np.flatnonzero(np.diff(high, prepend=-1))
        ends = np.append(cuts, len(offsets))[1:]
        self.high = high[cuts]
        self.containers = [container(offsets[a:b] - SPAN * h) for a, b, h in zip(cuts, ends, self.high, strict=True)]
        self.before = np.concatenate([[0], np.cumsum([len(c) for c in self.containers], dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, i: int) -> int:
        """The offset of rank ``i`` (from 0)."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        at = int(np.searchsorted(self.before, i, side="right")) - 1
        return SPAN * int(self.high[at]) + self.containers[at].select(i - int(self.before[at]))


def boundaries(text: str) -> BoundarySet:
    """Code point offsets behind the units ``[blanks]*[no blanks]+ | [blanks]+`` of ``text``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return BoundarySet(np.zeros(0, np.int64))
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    if blank[-1]:
        ends = np.append(ends, len(points))
    return BoundarySet(ends.astype(np.int64))


@dataclass(frozen=True)
class Rates:
    """Shares, in hundredths, of texts that are cut and, of these, of form spm."""

    cut: int = 50
    spm: int = 80
    salt: str = "42:"


def draws(doc_id, salt: str) -> list[int]:
    digest = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transform(doc_id, text: str, rates: Rates) -> tuple:
    """(n, form, prefix code points, middle code points, output) of one text."""
    h1, h2, h3, h4 = draws(doc_id, rates.salt)
    units = boundaries(text)
    n = len(units)
    if not text or h3 % 100 >= rates.cut or any(m in text for m in MARKERS):
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (units.select(k - 1) if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < rates.spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made of."""
    if form == "plain":
        return output
    front, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    if not output.startswith(front):
        raise ValueError(f"{form} output does not start with {front}")
    first, _, rest = output[len(front):].partition(second)
    other, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (other, first) if form == "spm" else (first, other)
    return prefix + middle + suffix


FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def fill_middle(docs: DataFrame, rates: Rates = Rates(), digests: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, further columns) with what :func:`transform`
    gives, in columns named ``fim_…``; with ``digests`` also the SHA-256 of the
    output and of the text restored from it."""
    ship(docs.sparkSession)
    taken = {c.lower() for c in docs.columns}
    names = [f"fim_{f.split()[0]}" for f in FIELDS.split(", ")] + ["fim_output_sha256", "fim_restored_sha256"] * digests
    if clash := taken.intersection(names):
        raise ValueError(f"columns in the way: {sorted(clash)}")

    def hashed(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        for batch in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                row = transform(doc_id, text or "", rates)
                rows.append(row + ((hashed(row[4]), hashed(restore(row[4], row[1]))) if digests else ()))
            new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, *names])

    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()][:len(names)]
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.StringType())
    fields = [T.StructField(n, k) for n, k in zip(names, kinds[:len(names)], strict=True)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def op13_fill_middle(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    out = fill_middle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), digests=True)
    return out.select("doc_id", F.col("fim_n").alias("n"), F.col("fim_form").alias("form"),
                      F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
                      F.col("fim_output_sha256").alias("output_sha256"), F.col("fim_restored_sha256").alias("restored_sha256"))


ORACLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
    CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM drawn),
formed AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
    least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:], '') AS suffix FROM formed)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
         ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
