"""Edit-aware token counts.

A text's pre-tokens are the leaves of a segment tree whose nodes hold sums of
characters and tokens. An edit finds its leaves by descending along the sums of
characters, cuts the text again into pre-tokens from a little before the edit
until the cuts meet the old ones, encodes those pre-tokens alone, and updates
the sums above them. The total then stands at the root.

Why that is exact: the pattern has no look-behind, so the cuts from a boundary on
depend on the text behind it alone; a match looks at most ``AHEAD`` characters
beyond its end, so leaves that end ``AHEAD`` before an edit stay; and from a cut
behind the edit that is an old cut, text and cuts are the old ones.

Edits (at, cut, put) name places in the original text: ``cut`` characters from
``at`` on are replaced by ``put``. They are applied from the last to the first;
one that reaches into the next is shortened to end there, and places outside the
text are moved to its ends.

Edge cases: a null text counts as empty (0 tokens, and edits may fill it); null
or no edits leave the count as it is; null parts of an edit count as 0 or
nothing; rows that repeat a doc_id are counted each; an empty table gives an
empty result; further columns are ignored. A row's memory is linear in its text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import ship, text_slices

AHEAD, CONTEXT = 3, 48

#: Distinct pre-tokens whose counts a Python worker remembers before it starts anew (speed only): about 20 MB.
REMEMBERED = 150_000

SCHEMA = "doc_id long, n_tokens long, n_pretokens long, edited_tokens long, recounted long"


class Counter:
    """Tokens of pre-tokens under a byte-pair vocabulary given as ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known = {}

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        missing = set(parts).difference(known)
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = set(parts)
        for part in missing:
            known[part] = len(self.encoding.encode_ordinary(part))
        return [known[part] for part in parts]


class Tree:
    """Segment tree over pre-tokens. A leaf begins as one pre-token; an edit
    puts all new pre-tokens in its first leaf and empties the others it touched."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        parts = counter.cut(text)
        self.leaves = len(parts)
        self.width = 1 << max(0, (self.leaves - 1).bit_length())
        self.chars, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        self.chars[self.width:self.width + self.leaves] = [len(p) for p in parts]
        self.tokens[self.width:self.width + self.leaves] = counter.counts(parts)
        level = self.width
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2:level] = sums[level:2 * level:2] + sums[level + 1:2 * level:2]
            level //= 2
        self.inside = {}  # leaf -> lengths of its pre-tokens, where not one
        self.recounted = 0

    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, its first character); the last
        leaf with characters if ``at`` is the end."""
        node, start = 1, 0
        at = min(at, int(self.chars[1]) - 1)
        while node < self.width:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def set(self, leaf: int, chars: int, tokens: int):
        node = leaf + self.width
        self.chars[node], self.tokens[node] = chars, tokens
        node //= 2
        while node:
            for sums in (self.chars, self.tokens):
                sums[node] = sums[2 * node] + sums[2 * node + 1]
            node //= 2

    def edit(self, at: int, cut: int, put: str):
        """Replace ``cut`` characters from ``at`` on by ``put``."""
        old = self.text
        self.text = old[:at] + put + old[at + cut:]
        if not old:
            return self.start_over()
        first, begin = self.find(max(0, at - AHEAD))
        stop, shift = at + cut, len(put) - cut
        # leaves from `first` on, with their boundaries, as far as they are needed
        last, edge = first, begin + int(self.chars[first + self.width])
        context = CONTEXT
        while True:
            end = min(len(old), stop + context)
            while edge < end:
                last += 1
                edge += int(self.chars[last + self.width])
            edges, place = {}, begin  # old boundary -> last leaf before it
            for leaf in range(first, last + 1):
                place += int(self.chars[leaf + self.width])
                edges[place] = leaf
            region = self.text[begin:edge + shift]
            whole = edge == len(old)
            parts, place, met = [], begin, None
            for part in self.counter.cut(region):
                parts.append(part)
                place += len(part)
                if not whole and place > edge + shift - AHEAD:
                    break
                if place >= at + len(put) and (place - shift in edges) and place - shift >= stop:
                    met = edges[place - shift]
                    break
            if met is None and whole:
                met = last
            if met is not None:
                break
            context *= 2
        counts = self.counter.counts(parts)
        self.recounted += len(parts)
        for leaf in range(first + 1, met + 1):
            if self.chars[leaf + self.width]:
                self.set(leaf, 0, 0)
        self.set(first, sum(map(len, parts)), sum(counts))

    def start_over(self):
        fresh = Tree(self.text, self.counter)
        recounted = self.recounted + fresh.leaves
        self.__dict__.update(fresh.__dict__)
        self.recounted = recounted


def in_order(edits, length: int) -> list[tuple[int, int, str]]:
    """Edits from the last to the first, clipped to the text and to each other."""
    out, limit = [], length
    places = [(min(max(e["at"] or 0, 0), length), max(e["cut"] or 0, 0), e["put"] or "") for e in edits or [] if e is not None]
    for at, cut, put in sorted(places, key=lambda e: e[0], reverse=True):
        out.append((at, min(cut, limit - at), put))
        limit = at
    return out


@functools.lru_cache(maxsize=1)
def counter_of(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def count_edited(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_pretokens, edited_tokens, recounted) of rows
    (doc_id, text, edits): tokens before and after the edits, and pre-tokens
    that the edits had counted again. ``edits`` is array<struct<at, cut, put>>."""
    import public_tokenizers
    ship(docs.sparkSession)
    path, pattern = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN

    def run(batches):
        counter = counter_of(path, pattern)
        for batch in text_slices(batches):
            before, leaves, after, again = [], [], [], []
            for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                tree = Tree(text or "", counter)
                before.append(tree.total())
                leaves.append(tree.leaves)
                for at, cut, put in in_order(edits, len(tree.text)):
                    tree.edit(at, cut, put)
                after.append(tree.total())
                again.append(tree.recounted)
            yield pa.record_batch([batch.column("doc_id")] + [pa.array(c, pa.int64()) for c in (before, leaves, after, again)],
                                  names=[c.split()[0] for c in SCHEMA.split(", ")])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("edits").cast("array<struct<at:int,cut:int,put:string>>").alias("edits"))
            .mapInArrow(run, SCHEMA))


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """(doc_id, text, edits) from a table of edits (doc_id, at, cut, put)."""
    own = edits.groupBy(F.col("doc_id").alias("edit_id")).agg(F.collect_list(F.struct("at", "cut", "put")).alias("edits"))
    return docs.select("doc_id", "text").join(own, F.col("doc_id").eqNullSafe(F.col("edit_id")), "left").select("doc_id", "text", "edits")


def revision(text, source) -> list:
    """The query's edits of a text: an insertion of its source's name at a quarter,
    its first words moved in at the half, a deletion at three quarters."""
    n = F.length(text)
    edit = lambda at, cut, put: F.struct(F.floor(at).cast("int").alias("at"), cut.cast("int").alias("cut"), put.alias("put"))
    return F.array(edit(n / 4, F.lit(0), F.concat(F.lit(" ("), F.coalesce(source, F.lit("?")), F.lit(") "))),
                   edit(n / 2, F.lit(9), F.substring(text, 1, 40)),
                   edit(n * 3 / 4, F.least(F.lit(25), n), F.lit("")))


def op6_token_counts(docs: DataFrame) -> DataFrame:
    """Counts of every whole document before and after its revision."""
    return count_edited(docs.select("doc_id", "text", revision(F.col("text"), F.col("source")).alias("edits")))
