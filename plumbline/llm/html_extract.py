"""Main text of web pages by consensus host paths.

First pass: every page's containers are scored (share of the page's clean text, links, meaning of
tag and class) and the best few vote for their generalised path, that is the tags and classes from
the root with digits blurred.  Votes are summed by host and path in Spark, one path wins a host.
Second pass: each page gives the text under its host's winning path, or, where it has no such
element, under its own best container.  Menus, headers outside the article, footers, asides, forms,
scripts, styles, notices, adverts, comments of readers and hidden elements are left out in both.

What only a word of its class or id marks as such is judged after parsing: an element stays if it is
or holds the main element or an article (of half the largest article's text or more, and not within
comments or recommendations), or, where there is no such part or its name is doubtful, holds most of
the text that tags alone leave (MOST); and where
these words leave a page without text, they are ignored for the page.  Names of which every word
speaks of boilerplate (PLAIN_WORDS aside) are believed anywhere; words that articles use as well
(WEAK), and names that hold other words too, count within an article only for an element that is
mostly links (LINKED).

A page's paths are numbers of (parent's path, step); only paths that are voted for are spelled out,
so deep pages take memory and time in proportion to their size.  Pages are read a bounded number of
bytes at a time.  Winners (one row a host) are broadcast only if they were counted and are under
BROADCAST_HOSTS; otherwise the join is shuffled, where adaptive execution splits a host with many pages.

Edge cases: null or empty html gives an empty text; text without any tags is taken whole; unclosed
and stray tags are repaired as browsers do for the common cases; a null or empty url has no host, and
such pages rely on their own best container; of paths with equal votes the greater one wins; very
long and very deep pages are read whole; repeated rows get equal results; only page_id, url and html
are read.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .textvec import steps

VOTES = 3
MOST = 0.5
BROADCAST_HOSTS = 200_000
#: Share of links in an element's text from which a doubtful name is believed.
LINKED = 0.5
STEP_BYTES = 2_000_000

# What the tags and the words of classes, ids and roles mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg xmp".split())
DROP = frozenset("script style title textarea noscript template iframe svg annotation annotation-xml head nav footer aside form button select dialog menu canvas object audio video".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "head", "html", "body", "option", "legend"}
CONTAINER = frozenset("article body center div main section td".split())
BOILER = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe subscription "
    "signup popup modal overlay sidebar sidebars side widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer masthead topbar comment comments commentlist disqus respond "
    "reply replies discussion share sharing social related recommended recommendations toolbar login search skip outbrain taboola".split()
)
#: Of these, what marks lists that are often made of small articles.
LISTS = frozenset("comment comments commentlist disqus respond reply replies discussion related recommended recommendations outbrain taboola".split())
#: Of these, what articles have for parts of their own; and words that say nothing by themselves.
WEAK = frozenset("side discussion social related share sharing banner search skip menu menus navigation reply replies respond overlay toolbar login recommendations pagination".split())
PLAIN_WORDS = frozenset("area bar block body box button buttons col column container content group holder inner inline item items left link links list main module outer panel right row section slot text top unit wrap wrapper".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
MEANT = frozenset("article articlebody post content contents entry story main text body maincontent".split())
IMPLIED = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "p": "p"}
STOPS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table tbody thead tfoot", "td": "table tr", "th": "table tr", "option": "select", "p": "table td th div article section main body li blockquote"}

_TOKEN = re.compile(r"<!--.*?-->|<!--.*\Z|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[a-zA-Z/][^>]*\Z", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|=|$)")
_STOP = {k: frozenset(v.split()) for k, v in STOPS.items()}
_IMPLIED = {k: frozenset(v.split()) for k, v in IMPLIED.items()}


class Page:
    """Elements in document order, with path, parent and whether they are left out; and the runs of text."""

    def __init__(self, source: str):
        self.tags, self.steps, self.parents, self.dropped, self.weights, self.depths = ["#"], [""], [-1], [False], [0.0], [0]
        self.named: list[int] = []  # elements that a word of their class or id marks as boilerplate
        self._lists: set[int] = set()  # those of them that such a word marks as a list
        self._doubtful: set[int] = set()  # those of them whose names articles have too
        self._open: Counter[str] = Counter({"#": 1})  # tags on the stack
        self.runs: list[tuple[int, str | None]] = []  # (element, text), or (element, None) for a border between blocks
        self._stack = [0]
        at = 0
        raw = ""
        for m in _TOKEN.finditer(source):
            if m.start() < at:  # inside a script or the like
                continue
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._end(tag)
                continue
            attrs = m[3] if m[2] else m[6]
            self._start(tag, attrs or "")
            if tag in RAW and not (attrs or "").endswith("/"):
                raw = f"</{tag}"
                end = re.compile(re.escape(raw) + r"(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                self._end(tag)
        if at < len(source):
            self._text(source[at:])
        if self.named:
            self._judge()

    def _judge(self) -> None:
        """Drops the named elements, but for those that are or hold the main part of the page."""
        n = len(self.tags)
        sizes, links, linked, listed = [0] * n, [0] * n, [False] * n, [False] * n
        for e in range(1, n):
            linked[e] = linked[self.parents[e]] or self.tags[e] == "a"
        for e, text in self.runs:
            if text and not text.isspace():
                sizes[e] += len(text)
                links[e] += len(text) * linked[e]
        total = sum(sizes)
        for e in range(n - 1, 0, -1):
            sizes[self.parents[e]] += sizes[e]
            links[self.parents[e]] += links[e]
        for e in self.named:
            listed[e] = e in self._lists and sizes[e] <= MOST * total
        for e in range(1, n):
            listed[e] = listed[e] or listed[self.parents[e]]
        stories = [e for e in range(n) if self.tags[e] == "article" and sizes[e] and not listed[e]]
        least = max((sizes[e] for e in stories), default=0) / 2
        central = [t == "main" and sizes[e] > 0 for e, t in enumerate(self.tags)]
        for e in stories:
            central[e] = central[e] or sizes[e] >= least
        known = any(central)
        within = list(central)  # is or lies in the main part
        for e in range(1, n):
            within[e] = within[e] or within[self.parents[e]]
        for e in range(n - 1, 0, -1):
            if central[e]:
                central[self.parents[e]] = True
        out = list(self.dropped)
        for e in self.named:
            sure = not within[e] or e not in self._doubtful or links[e] >= LINKED * max(sizes[e], 1)
            if sure and not central[e] and (sizes[e] <= MOST * total or known and e not in self._doubtful):
                out[e] = True
        for e in range(1, n):
            out[e] = out[e] or out[self.parents[e]]
        if total and not any(text and not text.isspace() and not out[e] for e, text in self.runs):
            return
        self.dropped = out
        self.runs = [(e, text) for e, text in self.runs if text is None or not out[e]]

    def _text(self, text: str) -> None:
        e = self._stack[-1]
        if not self.dropped[e]:
            self.runs.append((e, text))

    def _break(self) -> None:
        self.runs.append((self._stack[-1], None))

    def _start(self, tag: str, attrs: str) -> None:
        stack, tags = self._stack, self.tags
        closes = _IMPLIED.get(tag)
        if closes is None and tag in CLOSES_P:
            closes = _IMPLIED["p"]
        if closes is not None and any(self._open[t] for t in closes):
            stop = _STOP.get(tag, _STOP["p"])
            for k in range(len(stack) - 1, 0, -1):
                t = tags[stack[k]]
                if t in closes:
                    self._close(k)
                    break
                if t in stop:
                    break
        if tag in BLOCK:
            self._break()
        if tag in VOID:
            return
        parent = stack[-1]
        found = {}
        if "=" in attrs or "hidden" in attrs:
            found = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(attrs)}
            if _HIDDEN.search(attrs) or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
                found["hidden"] = "1"
        classes = found.get("class", "").lower().split()
        self.tags.append(tag)
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1)
        self.steps.append(tag + "".join("." + c for c in sorted({_DIGITS.sub("#", c) for c in classes})) if classes else tag)
        self.dropped.append(self.dropped[parent] or self._left_out(tag, found))
        if not self.dropped[-1] and (names := self._names(tag, classes, found)):
            self.named.append(len(self.tags) - 1)
            if any(w in LISTS for words in names for w in words):
                self._lists.add(len(self.tags) - 1)
            if not any(all(w in BOILER or w in PLAIN_WORDS for w in words) and any(w in BOILER and w not in WEAK for w in words) for words in names):
                self._doubtful.add(len(self.tags) - 1)
        words = {w for c in classes for w in _WORD.findall(c)} | set(_WORD.findall(found.get("id", "").lower())) if classes or "id" in found else set()
        meant = 1.5 if tag == "article" else 1.3 if tag == "main" or found.get("role") == "main" else 1.4 if found.get("itemprop", "").lower() == "articlebody" else 1.25 if words & MEANT else 0.8 if tag == "body" else 1.0
        self.weights.append(meant if tag in CONTAINER else 0.0)
        stack.append(len(tags) - 1)
        self._open[tag] += 1

    def _close(self, k: int) -> None:
        """Takes the stack's elements from k on away."""
        for e in self._stack[k:]:
            self._open[self.tags[e]] -= 1
        del self._stack[k:]

    def _left_out(self, tag: str, found: dict[str, str]) -> bool:
        if tag in DROP or "hidden" in found or found.get("role", "").lower() in BOILER_ROLES:
            return True
        return tag == "header" and not (self._open["article"] or self._open["main"])

    def _names(self, tag: str, classes: list[str], found: dict[str, str]) -> list[list[str]]:
        """Those of the element's classes and id, as words, that hold a word of boilerplate."""
        if tag in ("html", "body", "main"):
            return []
        names = [_WORD.findall(name) for name in (*classes, found.get("id", "").lower())]
        return [w for w in names if w and w[0] not in ("has", "with", "no", "without", "is") and not BOILER.isdisjoint(w)]

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._break()
        stack, tags = self._stack, self.tags
        if tag in VOID or not self._open[tag]:
            return
        for k in range(len(stack) - 1, 0, -1):
            if tags[stack[k]] == tag:
                self._close(k)
                break
        if tag in BLOCK:
            self._break()

    def candidates(self) -> list[tuple[float, int]]:
        """(score, element) of the containers, best first."""
        n = len(self.tags)
        clean, link, linked = [0] * n, [0] * n, [False] * n
        for e in range(1, n):
            linked[e] = linked[self.parents[e]] or self.tags[e] == "a"
        for e, text in self.runs:
            if text and (size := len(text) if not text.isspace() else 0):
                clean[e] += size
                if linked[e]:
                    link[e] += size
        for e in range(n - 1, 0, -1):
            clean[self.parents[e]] += clean[e]
            link[self.parents[e]] += link[e]
        total = clean[0]
        out = []
        for e in range(n):
            if clean[e] and not self.dropped[e] and (self.weights[e] or e == 0):
                share = clean[e] / total
                depth = min(20, self.depths[e])
                out.append((share * share * (1.02 - link[e] / clean[e]) * (self.weights[e] or 0.5) * (1 + 0.01 * depth), e))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def text(self, roots: set[int]) -> str:
        """The blocks under some elements, in page order."""
        n = len(self.tags)
        inside = [False] * n
        for e in range(n):
            inside[e] = e in roots or (e > 0 and inside[self.parents[e]])
        blocks, open_block = [], []
        for e, text in self.runs:
            if text is None:
                if open_block:
                    blocks.append("".join(open_block))
                    open_block = []
            elif inside[e]:
                open_block.append(_html.unescape(text) if "&" in text else text)
        if open_block:
            blocks.append("".join(open_block))
        return " ".join(" ".join(blocks).split())

    def path(self, e: int) -> str:
        """The steps from the root to an element."""
        out = []
        while e:
            out.append(self.steps[e])
            e = self.parents[e]
        return "".join(">" + x for x in reversed(out))

    def at(self, path: str) -> set[int]:
        """The elements of this path that are not left out."""
        want = path.split(">")[1:]
        on = [True] + [False] * (len(self.tags) - 1)
        found = set()
        for e in range(1, len(self.tags)):
            d = self.depths[e]
            if d <= len(want) and on[self.parents[e]] and self.steps[e] == want[d - 1]:
                on[e] = True
                if d == len(want) and not self.dropped[e]:
                    found.add(e)
        return found

    def best(self) -> set[int]:
        found = self.candidates()
        return {found[0][1]} if found else set()


def votes_of(source: str | None) -> list[tuple[str, float]]:
    """The paths that a page votes for, with weights of 1 at most."""
    page = Page(source or "")
    found = page.candidates()[:VOTES]
    return [(page.path(e), s / found[0][0]) for s, e in found if s > 0]


def extract(source: str | None, path: str | None) -> str:
    page = Page(source or "")
    roots = page.at(path) if path else set()
    text = page.text(roots) if roots else ""
    return text or page.text(page.best())


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_paths(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """host, path: the path that won each host's vote."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(1), STEP_BYTES):
                hosts, paths, weights = [], [], []
                for host, source in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), strict=True):
                    for path, weight in votes_of(source):
                        hosts.append(host)
                        paths.append(path)
                        weights.append(round(1_000_000 * weight))
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(weights, pa.int64())], names=["host", "path", "weight"])

    named = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).filter(F.col("host") != "")
    cast = named.mapInArrow(vote, "host string, path string, weight long").groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    return cast.groupBy("host").agg(F.max_by("path", F.struct("weight", "path")).alias("path"))


def extract_main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Per page: page_id, url, text."""
    winners = checkpointed(host_paths(pages, url=url, html=html)).select(F.col("host").alias("w_host"), "path")
    if winners.count() <= broadcast_hosts:
        winners = F.broadcast(winners)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.join(winners, host_of(F.col("url")) == F.col("w_host"), "left").select("page_id", "url", "html", "path")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(2), STEP_BYTES):
                part = batch.slice(a, b - a)
                texts = [extract(s, p) for s, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(take, f"page_id {kind}, url string, text string")
