"""Main text of HTML pages by deduction of each host's template.

A page is a sequence of *tokens*: starts and ends of block elements, told apart
by the path of elements above them and, for boxes, by their number among like ones,
and text blocks (path and whole text).
Over the pages of a host, a token's *occurrence vector* holds how often it
stands on each page. Tokens with the same vector form an equivalence class.
Classes that stand on enough of the host's pages, keep their tokens in one
order on nearly all of them, and lie in one gap of the root class (the tokens
that stand once on every page) make up the template. What remains between
template tokens are its slots; text blocks that are template tokens are
boilerplate. From the slots, elements of page furniture (by tag, role, class
and id names), texts outside the article where a page has one, and slots that
are mostly links are left out.

Vectors are never formed as such: each is the sum over pages of count times a
random number of the page, in three lanes modulo 2**32, which partial sums add
up to; equal sums stand for equal vectors (wrong with a probability of 2**-96
for two tokens). A host's template holds at most 1 / ``SHARE`` times the tokens
of an average page, so it is one bounded row.

Edge cases: a null or empty html gives an empty text; a null url counts as the
host ''; hosts with fewer than ``LEAST_PAGES`` pages have no template, and
their pages are judged by element names alone; rows that repeat a page_id are
pages of their own; an empty table gives an empty result; further columns are
ignored. Unclosed elements end with the element around them; an unclosed
script or comment reaches to the end of the page.
"""

from __future__ import annotations

import functools
import html as references
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import mix64, ship, store, text_slices

#: Pages that a host must have, and the share of them on which a template token stands.
LEAST_PAGES, SHARE = 8, 0.6
#: Share of a class's pages on which its tokens may be out of order.
DISORDER = 0.05
#: Share of link text from which a slot outside an article is a menu.
LINKS = 0.7
#: Token of the page itself: it stands once on every page.
PAGE = 1

# FIXED VALUES: elements of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split())
FURNITURE = frozenset(
    "head nav aside footer form script style noscript template iframe object embed svg math canvas audio video select button "
    "textarea input datalist dialog menu search map".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements told apart by their number among like ones of the same parent.
BOXES = frozenset("article aside center details div fieldset footer form header main nav section table".split())
#: An element of the key ends open ones of the values, up to the nearest of ENCLOSING.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}}
ENCLOSING = frozenset("ul ol dl menu table div section article body html".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Words of class and id names that mark page furniture; those of START also as the beginning of a word.
NAMES = frozenset(
    "ad ads adbox adslot nav menu aside login signup register search share sharing social alert notice notices skip copyright toolbar "
    "respond reply replies discussion related recommended outbrain taboola hidden teaser teasers overlay".split())
START = ("advert", "sidebar", "breadcrumb", "cookie", "consent", "gdpr", "newsletter", "footer", "masthead", "navbar", "navigation", "sponsor",
         "comment", "disqus", "subscri", "promo", "banner", "popup", "modal", "pagina", "pager", "widget")
#: First words of names that only say that a part is there or not.
ABOUT = frozenset("has with without no is".split())
#: Names of furniture outside articles only.
HEAD = frozenset("header topbar".split())

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>"']|"[^"]*"|'[^']*')*+>|[^<>]*>?)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|itemprop|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NUMBER = re.compile(r"\d{3,}")


def hash64(*parts) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))


def element(name: str, attributes: str) -> tuple[str, bool, bool, bool, bool]:
    """What a start tag says: signature, furniture by tag or role, furniture by
    name, page head, article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    role = found.get("role", "").lower()
    article = name in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    by_tag = (name in FURNITURE or role in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
              or "display:none" in found.get("style", "").replace(" ", "").lower())
    words = set()
    if name not in ("html", "body"):
        for label in f"{found.get('class', '')} {found.get('id', '')}".split():
            own = [w.lower() for w in WORD.findall(label)]
            if own and own[0] not in ABOUT:
                words.update(own, ["".join(own)])
    named = bool(words & NAMES) or any(w.startswith(START) for w in words)
    signature = NUMBER.sub("0", f"{name} {found.get('class', '')} {found.get('id', '')}")
    return signature, by_tag, named, name == "header" or bool(words & HEAD), article


#: Start tags repeat; long ones are not kept.
remembered = functools.lru_cache(maxsize=4096)(element)


class Page:
    """Tokens of a page in order; ``blocks`` holds its texts as (token number,
    text, level, characters in links). The level is -1 for furniture, 0
    outside articles, 1 in the main part, 2 in an article, 3 in one of the main part."""

    def __init__(self, source: str):
        self.tokens = [PAGE]
        self.blocks: list[tuple[int, str, int, int]] = []
        # name, path, level, furniture by tag, path with numbers, numbers of inner elements by signature
        self.stack: list[tuple[str, int, int, bool, int, dict[str, int]]] = []
        self.page = ("", 0, 0, False, 0, {})
        self.open: dict[str, int] = {}
        self.text: list[str] = []
        self.linked = 0
        self.link = False
        self.read(source)

    def top(self) -> tuple[str, int, int, bool, int, dict[str, int]]:
        return self.stack[-1] if self.stack else self.page

    def flush(self):
        if not self.text:
            return
        text = " ".join("".join(self.text).split())
        linked, self.text, self.linked = self.linked, [], 0
        if text:
            _, path, level, *_ = self.top()
            self.blocks.append((len(self.tokens), text, level, linked))
            self.tokens.append(hash64(path, text))

    def say(self, text: str):
        if text:
            text = references.unescape(text) if "&" in text else text
            self.text.append(text)
            if self.link:
                self.linked += len(text.strip())

    def pop(self):
        name, _, _, _, place, _ = self.stack.pop()
        self.open[name] -= 1
        self.tokens.append(place ^ 0x5555555555555555)

    def start(self, name: str, attributes: str):
        self.flush()
        if name in BLOCKS and self.open.get("p"):  # a block ends an open paragraph
            if self.top()[0] == "p":
                self.pop()
        if ends := ENDS.get(name):
            while self.stack and self.top()[0] in ends | {"p"} and self.top()[0] not in ENCLOSING:
                self.pop()
        signature, by_tag, named, head, article = (remembered if len(attributes) < 300 else element)(name, attributes)
        _, path, level, within, place, inner = self.top()
        if by_tag or within:
            own, within = -1, True
        elif article and not named:
            main = name == "main" or (name != "article" and level <= 0)
            own = max(level, 1) if main else 3 if level in (1, 3) else 2
        elif named or (head and level == 0):
            own = -1
        else:
            own = level
        number = 0
        if name in BOXES:
            number = inner[signature] = inner.get(signature, 0) + 1
        place = hash64(place, signature, number)
        self.tokens.append(place)
        self.stack.append((name, hash64(path, signature), own, within, place, {}))
        self.open[name] = self.open.get(name, 0) + 1
        if name in VOID:
            self.pop()

    def end(self, name: str):
        if not self.open.get(name):
            return
        self.flush()
        while True:
            last = self.top()[0]
            self.pop()
            if last == name:
                return

    def read(self, source: str):
        at = 0
        while m := TOKEN.search(source, at):
            self.say(source[at:m.start()])
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if name == "a":
                self.link = not m[1]
            elif name == "br":
                self.text.append(" ")
            if name in RAW and not m[1]:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                at = close.end() if close else len(source)
                self.flush()
                self.tokens.append(hash64(self.top()[1], name))
            elif name in BLOCKS or (name in FURNITURE and name not in VOID):
                self.end(name) if m[1] else self.start(name, m[3])
        self.say(source[at:])
        self.flush()
        while self.stack:
            self.pop()

    def main_text(self, template: set[int]) -> str:
        """The text of the slots that belong to the article."""
        slot, slots = 0, []
        number = 0
        for at, text, level, linked in self.blocks:
            while number < at:
                slot = number if self.tokens[number] in template else slot
                number += 1
            if level >= 0 and self.tokens[at] not in template:
                slots.append((slot if template else at, level, linked, text))  # without a template, each block by itself
        levels = {level for _, level, _, _ in slots}
        best = next((level for level in (3, 1, 2) if level in levels), 0)
        if best:
            kept = [text for _, level, _, text in slots if level == best]
        else:
            size: dict[int, list[int]] = {}
            for slot, _, linked, text in slots:
                have = size.setdefault(slot, [0, 0])
                have[0] += linked
                have[1] += len(text)
            kept = [text for slot, _, _, text in slots if size[slot][0] < LINKS * size[slot][1]]
        return "\n\n".join(kept)


def host_of(url):
    """The url's host in lower case, without port; '' where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def sequences(pages: DataFrame) -> DataFrame:
    """(host, page, tokens) of every page; ``page`` is a random number of it."""
    def run(batches):
        for batch in text_slices(batches, "html"):
            found = [np.array(Page(h or "").tokens, np.uint64).tobytes() for h in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("host"), batch.column("page"), pa.array(found, pa.binary())], names=["host", "page", "tokens"])

    return pages.select("host", "page", "html").mapInArrow(run, "host string, page long, tokens binary")


LANES = ("v1", "v2", "v3")
MASK = np.uint64(0xFFFFFFFF)


def grouped(batches):
    """Batches by host: (host, rows of the batch)."""
    for batch in batches:
        rows: dict[str, list[int]] = {}
        for i, host in enumerate(batch.column("host").to_pylist()):
            rows.setdefault(host, []).append(i)
        for host, at in rows.items():
            yield host, batch.take(pa.array(at))


def vectors(pages: DataFrame) -> DataFrame:
    """Per (host, token): the pages it stands on, its vector's sums, and the
    sum of its first places."""
    def run(batches):
        for host, batch in grouped(batches):
            sequence = [np.frombuffer(t, np.uint64) for t in batch.column("tokens").to_pylist()]
            page = np.repeat(np.arange(len(sequence)), [len(s) for s in sequence])
            place = np.concatenate([np.arange(len(s)) for s in sequence])
            every, code = np.unique(np.concatenate(sequence), return_inverse=True)
            keys, first, count = np.unique(code * len(sequence) + page, return_index=True, return_counts=True)
            token, on = keys // len(sequence), keys % len(sequence)
            number = batch.column("page").to_numpy().astype(np.uint64)
            columns = [np.bincount(token)]
            for lane in range(3):
                weight = mix64(number + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)) & MASK
                # exact: sums of fewer than 2**21 numbers of 32 bits
                sums = np.bincount(token, weights=((weight[on] * count.astype(np.uint64)) & MASK).astype(np.float64))
                columns.append(sums.astype(np.int64) & int(MASK))
            places = np.bincount(token, weights=place[first]).astype(np.int64)
            yield pa.record_batch([pa.array([host] * len(every), pa.string()), pa.array(every.view(np.int64)), *map(pa.array, columns), pa.array(places)],
                                  names=["host", "token", "pages", *LANES, "places"])

    sums = pages.mapInArrow(run, "host string, token long, pages long, v1 long, v2 long, v3 long, places long")
    whole = sums.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("places").alias("places"),
                                             *(F.pmod(F.sum(v), F.lit(2**32)).alias(v) for v in LANES))
    return whole


def classes(tokens: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """Equivalence classes of tokens that stand on enough pages, one row per
    host: ``template`` packs (token, class, rank in the class), the root class
    first; classes of one token other than the root are no evidence."""
    per_host = tokens.where(F.col("token") == PAGE).select("host", F.col("pages").alias("host_pages"), *(F.col(v).alias(f"root_{v}") for v in LANES))
    often = tokens.where(F.col("pages") >= F.lit(least_pages * share)).join(per_host, "host")
    often = often.where((F.col("host_pages") >= least_pages) & (F.col("pages") >= F.col("host_pages") * share))
    root = F.col("v1") == F.col("root_v1")
    for v in LANES[1:]:
        root = root & (F.col(v) == F.col(f"root_{v}"))
    member = F.struct((F.col("places") / F.col("pages")).alias("place"), "token")
    made = (often.withColumn("root", root).groupBy("host", "host_pages", "root", *LANES)
            .agg(F.array_sort(F.collect_list(member)).alias("members"), F.max("pages").alias("pages"))
            .where(F.col("root") | (F.size("members") > 1)))
    one = F.struct((~F.col("root")).alias("inner"), F.col("members")[0]["token"].alias("head"), "pages", F.transform("members", lambda m: m["token"]).alias("tokens"))
    return made.groupBy("host", "host_pages").agg(F.array_sort(F.collect_list(one)).alias("classes"))


def disorder(batches):
    """Per host and class: pages out of order, and the gaps of the root class in which it stands."""
    for host, batch in grouped(batches):
        known = batch.column("classes")[0].as_py()
        places = {t % 2**64: (c, r) for c, own in enumerate(known) for r, t in enumerate(own["tokens"])}
        size = [len(own["tokens"]) for own in known]
        wrong, low, high = [0] * len(size), [2**31] * len(size), [-1] * len(size)
        for tokens in batch.column("tokens").to_pylist():
            due, bad, gap = [0] * len(size), set(), 0
            for token in np.frombuffer(tokens, np.uint64).tolist():
                if (at := places.get(token)) is None:
                    continue
                c, rank = at
                if rank != due[c] % size[c]:
                    bad.add(c)
                due[c] += 1
                if c:
                    low[c], high[c] = min(low[c], gap), max(high[c], gap)
                else:
                    gap += 1
            for c in range(len(size)):
                wrong[c] += c in bad or due[c] % size[c] != 0
        n = len(size)
        yield pa.record_batch([pa.array([host] * n, pa.string()), *(pa.array(x, pa.int64()) for x in (range(n), wrong, low, high))],
                              names=["host", "number", "wrong", "low", "high"])


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE, allowed: float = DISORDER) -> DataFrame:
    """(host, template): the tokens of the valid classes of every host that has
    enough pages, of hosts with a valid root class. ``pages`` are :func:`sequences`."""
    found = store(classes(vectors(pages), least_pages, share), "html-classes")
    tested = (pages.join(found.select("host", "classes"), "host")
              .mapInArrow(disorder, "host string, number long, wrong long, low long, high long")
              .groupBy("host", "number").agg(F.sum("wrong").alias("wrong"), F.min("low").alias("low"), F.max("high").alias("high")))
    single = found.select("host", F.posexplode("classes").alias("number", "own")).join(tested, ["host", "number"])
    # a class stands in one gap of the root class, whose order counts as any other's
    valid = (F.col("wrong") <= F.col("own.pages") * allowed) & ((F.col("number") == 0) | (F.col("low") == F.col("high")))
    kept = single.where(valid).groupBy("host").agg(F.min("number").alias("first"), F.flatten(F.collect_list("own.tokens")).alias("template"))
    return kept.where("first = 0").select("host", "template")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page, with the number of
    template tokens of its host (0: judged by names alone)."""
    ship(pages.sparkSession)
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"),
                         F.xxhash64("page_id", "url").alias("page"))
    known = store(templates(store(sequences(pages), "html-tokens"), least_pages, share), "html-templates")

    def run(batches):
        for batch in text_slices(batches, "html"):
            texts, sizes = [], []
            own, of_host = batch.column("template"), {}
            for i, (source, host) in enumerate(zip(batch.column("html").to_pylist(), batch.column("host").to_pylist(), strict=True)):
                if host not in of_host:
                    of_host[host] = {t % 2**64 for t in own[i].as_py() or ()}
                texts.append(Page(source).main_text(of_host[host]))
                sizes.append(len(of_host[host]))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64())],
                                  names=["page_id", "url", "text", "n_chars", "template_tokens"])

    both = pages.join(known, "host", "left").select("page_id", "url", "html", "host", "template")
    return both.mapInArrow(run, "page_id long, url string, text string, n_chars long, template_tokens long")


def op11_html(pages: DataFrame) -> DataFrame:
    """The contract's rows."""
    return extract(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
