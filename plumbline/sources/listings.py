"""Listing pages of official sites as raw articles.

A layout says in data where a site's rows, links, titles, dates and numbers stand; one reader
serves them all.  A page gives an array of items (bounded by the page), so reading is one Arrow
UDF without a shuffle.  Sites that state number and date on the article's own page are read in two
steps that meet by URL: items and details.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import ship

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SILENT = frozenset(("script", "style", "template"))
_CELLS = ("td", "th")


class Node:
    """An element with its attributes and what it holds."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None = None) -> None:
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        todo = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while todo:
            n = todo.pop()
            yield n
            todo += [k for k in reversed(n.kids) if isinstance(k, Node)]

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def strings(self) -> Iterator[str]:
        todo: list[Node | str] = list(reversed(self.kids))
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in _SILENT:
                todo += reversed(n.kids)

    def text(self) -> str:
        """Its strings, each trimmed, in a row."""
        return "".join(s.strip() for s in self.strings())

    def only_string(self) -> str | None:
        """Its string if it holds just one, however deep."""
        n = self
        while len(n.kids) == 1 and isinstance(n.kids[0], Node):
            n = n.kids[0]
        return n.kids[0] if len(n.kids) == 1 else None

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def has_class(self, pattern: str) -> bool:
        """Whether a class, or the whole list of them, matches."""
        return any(re.search(pattern, c) for c in (*self.classes(), " ".join(self.classes())))


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {})

    def handle_starttag(self, tag, attrs):
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(n)
        if tag not in _VOID:
            self.at = n

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def tree(markup: str) -> Node:
    p = _Tree()
    p.feed(markup)
    p.close()
    return p.root


# Layouts -----------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Labelled:
    """A value that stands within reach characters after a label, in a text without blanks."""

    label: str
    pattern: str
    reach: int


@dataclass(frozen=True)
class Detail:
    """What an article's own page must say.  within: (class pattern, wanted text, unwanted text, must be there)."""

    number: Labelled | None = None
    number_meta: str | None = None
    number_in_title: str | None = None
    date: Labelled | None = None
    date_meta: str | None = None
    title_meta: str | None = None
    extra: tuple[tuple[str, Labelled], ...] = ()
    within: tuple[str, str | None, str | None, bool] | None = None


@dataclass(frozen=True)
class Layout:
    """Where a site's rows and their parts stand."""

    rows: str = "tr"  # tag, ".class tag" within the first such element, or a rule's name
    cells: int = 0  # rows with fewer cells aren't rows
    header: str | None = None  # rows whose first cell holds this are headers
    link: str | None = None  # pattern of the href
    link_class: str | None = None
    must_link: bool = False  # a row without such a link is faulty, not another kind of row
    title: int | str = "link"  # a cell, the link's text, or its title attribute first
    title_cut: str | None = None  # pattern to take away
    date: int | str | None = None  # a cell, or the class of a span ("" any)
    date_pattern: str | None = None
    number: tuple[str, str] | None = None  # (title, url, cell k or other link's pattern; pattern)
    number_clean: str | None = None
    meta: tuple[tuple[str, int], ...] = ()
    fixed: tuple[tuple[str, str], ...] = ()
    other_link: tuple[str, str] | None = None  # (pattern, name under which it is kept)
    needs: tuple[int, str] | None = None  # a cell that must hold a text
    drop_redirect: bool = False
    https: bool = False  # links given with http are meant with https
    moved: tuple[str, str] | None = None  # an origin and the one that serves its articles
    host: str | None = None
    path: str | None = None
    strict: bool = False  # links elsewhere are faulty rows, not other links
    channel: tuple[str, str] | None = None  # (tag or .class pattern, text) that the page must show
    once: bool = False
    next_link: tuple[tuple[str, str], ...] = ()
    detail: Detail | None = None


# Patterns of numbers and dates, and the sites' layouts.  `reach` counts characters after a label.
_FR_NUMBER = r"/documents/\d{4}/\d{2}/\d{2}/([^/]+)/"
_ART = r"/(art_[0-9a-fA-F]{32})\.html"
_WRITTEN = r"(\d{4}年\d{1,2}月\d{1,2}日|\d{4}-\d{2}-\d{2})"
_BANK = r"(中国人民银行令〔\d{4}〕第\d+号|中国人民银行等\w+令〔\d{4}〕第\d+号|中国人民银行令\d{4}年第\d+号)"
_PAGER = (("text", r"(?i)Next"), ("class", r"(?i)next"))

LAYOUTS = {
    "vn_sbv_regulatory_docs": Layout(rows=".danh-sach-tin-tuc-v32 li", link_class="title-news-link", must_link=True, date="date-about", number=("title", r"\b([0-9]+/[0-9]{4}/[A-Za-z0-đĐ\-]+)\b"), drop_redirect=True, next_link=(("title", "Trang kế tiếp"), ("rel", "next"))),
    "vn_moit_regulatory_docs": Layout(cells=4, title=1, date=3, number=("2", r"^(.*[0-9]+/[0-9]{4}/.*)$"), number_clean=r"^[Ss]ố[:\s]*", meta=(("document_number", 2),), drop_redirect=True, next_link=(("class", "^next$"), ("rel", "next"), ("text", "Sau"))),
    "vn_mst_regulatory_docs": Layout(cells=6, link=r"\.htm$", title=4, title_cut=r"(?i)Xem chi tiết$", date=5, number=("url", r"/van-ban-phap-luat/(\d+)\.htm"), meta=(("document_number", 0), ("issuer", 1), ("document_type", 2), ("field", 3)), drop_redirect=True, next_link=(("text", "Sau"), ("rel", "next"))),
    "us_bis_regulatory": Layout(rows="json:frns"),
    "us_fhfa_regulatory": Layout(cells=5, header="DateSort ascending", link=r"^/regulation/federal-register/", must_link=True, title=1, date=0, number=("other", _FR_NUMBER), meta=(("fhfa_number", 2), ("type", 3), ("fr_citation", 4)), other_link=("federalregister.gov", "federal_register_url"), next_link=_PAGER),
    "eu_esma_regulatory": Layout(cells=6, header="DateSort ascending", link=r"^/document/", must_link=True, title=2, date=0, number=("1", r"^(ESMA\d+-[a-zA-Z0-9\-]+)$"), meta=(("reference", 1), ("sections", 3), ("document_type", 4)), needs=(3, "Guidelines and Technical standards"), next_link=(*_PAGER, ("item", "(?i)pager__item--next"))),
    "cn_samr_market_regulation_bulletins": Layout(rows="li", title="title", date="", date_pattern=r"\d{4}-\d{2}-\d{2}", number=("url", _ART), https=True, host="www.samr.gov.cn", path="/art/", fixed=(("structural_category", "通知通告"),)),
    "cn_miit_policy_listing": Layout(rows="tab:政策文件", title="title", date="", date_pattern=r"\d{4}-\d{2}-\d{2}", number=("url", _ART), host="www.miit.gov.cn", path="^/zwgk/zcwj/"),
    "cn_state_council_policy_docs": Layout(rows="a", link=r"zhengce/(content|zhengceku)/", once=True, moved=("https://sousuo.www.gov.cn", "https://www.gov.cn"), host="www.gov.cn", path="^/zhengce/content/", strict=True, detail=Detail(number=Labelled("发文字号", r"^[:：]?(国[a-zA-Z0-9一-龥]+〔\d{4}〕\d+号|国令第\d+号|国函〔\d{4}〕\d+号)", 21), number_meta="发文字号", date=Labelled("成文日期", "^[:：]?" + _WRITTEN, 21))),
    "cn_pboc_regulatory_docs": Layout(rows="a", link=r"/\d{8,}/index\.html", host="www.pbc.gov.cn", path="^/tiaofasi/144941/144957/", strict=True, channel=(r".(?i)Position|breadcrumb|nav|hui12", "部门规章"), detail=Detail(number_in_title=_BANK, date_meta="PubDate", within=(r"(?i)Position|breadcrumb|nav|hui12", "部门规章", None, True))),
    "cn_csrc_regulatory_docs": Layout(rows="long a", link=r"content\.shtml", once=True, host="www.csrc.gov.cn", path="^/csrc/c101954/", strict=True, channel=("title", "证监会公告"), detail=Detail(number=Labelled("索引号", r"([a-zA-Z0-9]+/\d{4}-\d+)", 37), date=Labelled("发文日期", "^[:：]?" + _WRITTEN, 26), title_meta="ArticleTitle", extra=(("document_number", Labelled("文号", r"(证监会公告〔\d{4}〕\d+号)", 38)),), within=(r"(?i)Position|breadcrumb|nav", "证监会公告", None, False))),
    "cn_nea_regulatory_docs": Layout(rows="box:^(通知|公告)$", link=r"/c\.html", once=True, host="www.nea.gov.cn", strict=True, detail=Detail(number=Labelled("索引号", r"(\d{9,}/\d{4}-\d+)", 37), date=Labelled("制发日期", r"(\d{4}-\d{2}-\d{2})", 36), within=(r"(?i)Position|breadcrumb|nav", None, "新闻发布|解读|其他|项目核准", False))),
}

ITEM = "struct<source_item_id:string,url:string,title:string,published_at_raw:string,raw_metadata:map<string,string>>"
PAGE = f"struct<items:array<{ITEM}>,next_url:string,faulty:int,problem:string>"
FACTS = "struct<source_item_id:string,title:string,published_at_raw:string,raw_metadata:map<string,string>,problem:string>"


class LayoutDrift(ValueError):
    """The page doesn't show what its layout names."""


def _first(nodes, holds) -> Node | None:
    return next((n for n in nodes if holds(n)), None)


def _rows(page: Node, layout: Layout) -> list[Node]:
    kind, _, arg = layout.rows.partition(":")
    if kind == "tab":  # the panel of the tab that comes first and is named arg
        for bar in page.walk():
            tabs = bar.all("a") if bar.tag == "div" and bar.has_class("tabbox-hd") else []
            if tabs and arg in tabs[0].text():
                after = [k for k in bar.parent.kids if isinstance(k, Node)]
                body = _first(after[after.index(bar) + 1 :], lambda n: n.tag == "div" and n.has_class("tabbox-bd"))
                panel = _first(body.walk(), lambda n: n.tag == "div") if body else None
                if panel:
                    return panel.all("li")
        raise LayoutDrift(f"no panel {arg}")
    if kind == "box":  # links of every box that holds a heading like arg
        named = [b for b in page.all("div") if any(re.search(r"^h\d$|div|span", n.tag) and re.search(arg, n.only_string() or "") for n in b.walk())]
        return [a for b in named for a in b.all("a")]
    if layout.rows.startswith("."):
        name, tag = layout.rows[1:].split()
        box = _first(page.walk(), lambda n: name in n.classes())
        if box is None:
            raise LayoutDrift(f"no element of class {name}")
        return box.all(tag)
    if layout.rows == "long a":
        return [a for a in page.all("a") if len("".join(a.strings()).strip()) > 5]
    return page.all(layout.rows)


def _absolute(href: str, base: str, layout: Layout) -> str:
    url = urljoin(base, href)
    if layout.moved and url.startswith(layout.moved[0]):
        url = layout.moved[1] + url[len(layout.moved[0]) :]
    if layout.drop_redirect:
        parts = urlsplit(url)
        url = urlunsplit(parts._replace(query=urlencode([(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k != "redirect"])))
    if layout.https and url.startswith("http:"):
        url = "https" + url[4:]
    return url


def _belongs(url: str, layout: Layout) -> bool:
    parts = urlsplit(url)
    return layout.host is None or (parts.scheme == "https" and parts.netloc == layout.host and re.search(layout.path or "", parts.path) is not None)


def _item(row: Node, base: str, layout: Layout, seen: set[str]) -> dict | str | None:
    """A row as an item; its fault; or None if it is no row of the listing."""
    cells = row.all(*_CELLS) if layout.cells else []
    if len(cells) < layout.cells or layout.header and layout.header in "".join(cells[0].strings()):
        return None
    cell = [c.text() for c in cells]
    links = [row] if row.tag == "a" else row.all("a")
    link = _first(links, lambda a: (layout.link_class is None or layout.link_class in a.classes()) and (layout.link is None or re.search(layout.link, a.attrs.get("href", "").strip()) is not None))
    href = link.attrs.get("href", "").strip() if link else ""
    title = cell[layout.title] if isinstance(layout.title, int) else ((link.attrs.get("title") if layout.title == "title" else "") or link.text()) if link else ""
    title = re.sub(layout.title_cut, "", title).strip() if layout.title_cut else title
    if layout.needs and title and layout.needs[1] not in cell[layout.needs[0]]:
        return "missing_required_section"
    if link is None:
        return "missing_link" if layout.must_link else None
    if not href or href.startswith("javascript:"):
        return "missing_href" if layout.host is None else None
    if layout.once and href in seen:
        return None
    seen.add(href)
    url = _absolute(href, base, layout)
    if not _belongs(url, layout):
        return "elsewhere" if layout.strict else None
    if not title:
        return "missing_title"
    dated = cell[layout.date] if isinstance(layout.date, int) else None
    if isinstance(layout.date, str):
        span = _first(row.all("span"), lambda n: not layout.date or layout.date in n.classes())
        dated = span.text() if span else None
    if layout.date_pattern and dated:
        found = re.search(layout.date_pattern, dated)
        dated = found.group(0) if found else None
    other = _first(links, lambda a: layout.other_link is not None and layout.other_link[0] in a.attrs.get("href", ""))
    other_url = other.attrs["href"].strip() if other else None
    number = None
    if layout.number:
        where, pattern = layout.number
        text = {"title": title, "url": urlsplit(url).path, "other": other_url or ""}.get(where)
        text = cell[int(where)] if text is None else text
        found = re.search(pattern, re.sub(layout.number_clean, "", text).strip() if layout.number_clean else text)
        number = found.group(1).strip() if found else None
        number = number.lower() if number and pattern == _ART else number
    meta = {name: cell[k] for name, k in layout.meta if cell[k]} | dict(layout.fixed) | ({layout.other_link[1]: other_url} if other_url else {})
    return {"source_item_id": number, "url": url, "title": title, "published_at_raw": dated or None, "raw_metadata": meta}


def _next(page: Node, base: str, layout: Layout) -> str | None:
    for kind, value in layout.next_link:
        if kind == "item":
            box = _first(page.all("li"), lambda n: n.has_class(value))
            link = _first(box.all("a"), lambda n: True) if box else None
        else:
            tests = {"title": lambda a: a.attrs.get("title") == value, "rel": lambda a: value in a.attrs.get("rel", "").split(), "class": lambda a: a.has_class(value), "text": lambda a: re.search(value, a.only_string() or "") is not None}
            link = _first(page.all("a"), tests[kind])
        if link is not None:
            href = link.attrs.get("href", "").strip()
            return None if not href or href.startswith("javascript") else urljoin(base, href)
    return None


def _held(node: object, key: str) -> list | None:
    """The first list under key, a mapping's own keys before what they hold."""
    todo = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, dict):
            if isinstance(n.get(key), list):
                return n[key]
            todo += reversed(n.values())
        elif isinstance(n, list):
            todo += reversed(n)
    return None


def _embedded(page: Node, key: str) -> tuple[list[dict], int]:
    """Items that a page carries as JSON, and the number of faulty ones."""
    block = _first(page.all("script"), lambda n: n.attrs.get("id") == "__NEXT_DATA__" and n.attrs.get("type") == "application/json")
    try:
        records = _held(json.loads("".join(k for k in block.kids if isinstance(k, str))), key) if block else None
    except json.JSONDecodeError as e:
        raise LayoutDrift(f"malformed JSON: {e}") from e
    if records is None:
        raise LayoutDrift(f"no {key}")
    time = lambda r, k: (r.get(k) or {}).get("time") if isinstance(r.get(k) or {}, dict) else None
    items = []
    for r in records:
        url = (r.get("frnUrl") or {}).get("url")
        if not r.get("frnTitle") or not url:
            continue
        found = re.search(_FR_NUMBER, url) if "federalregister.gov" in url else None
        meta = {"fr_citation": r.get("frnCitation"), "effective_date": time(r, "frnEffectiveOnDate"), "document_category": r.get("frnDocumentType"), "regulation_set": r.get("frnRegulationType")}
        items.append({"source_item_id": found.group(1) if found else None, "url": url, "title": r["frnTitle"], "published_at_raw": time(r, "frnPublicationDate"), "raw_metadata": {k: str(v) for k, v in meta.items() if v}})
    return items, len(records) - len(items)


def read_page(layout: Layout, markup: str | None, base: str) -> dict:
    """A page's items, next page and problem (null if it can be used)."""
    page = tree(markup or "")
    try:
        if layout.channel:
            where, wanted = layout.channel
            sign = _first(page.walk(), (lambda n: n.has_class(where[1:])) if where.startswith(".") else (lambda n: n.tag == where))
            if sign is None or wanted not in "".join(sign.strings()):
                raise LayoutDrift(f"not in {wanted}")
        if layout.rows.startswith("json:"):
            items, faulty = _embedded(page, layout.rows[5:])
        else:
            seen: set[str] = set()
            found = [_item(r, base, layout, seen) for r in _rows(page, layout)]
            items, faulty = [f for f in found if isinstance(f, dict)], sum(isinstance(f, str) for f in found)
    except LayoutDrift as e:
        return {"items": [], "next_url": None, "faulty": 0, "problem": str(e)}
    onward = _next(page, base, layout)
    problem = "no usable row" if not items and faulty else "a next page but no row" if not items and onward else None
    return {"items": items, "next_url": onward, "faulty": faulty, "problem": problem}


def _after(text: str, what: Labelled | None) -> str | None:
    at = text.find(what.label) if what else -1
    if at < 0:
        return None
    start = at + len(what.label)
    found = re.search(what.pattern, text[start : start + what.reach])
    return found.group(1) if found else None


def read_detail(detail: Detail, markup: str | None, title: str) -> dict:
    """What an article's page says; problem names what is missing."""
    page = tree(markup or "")
    text = re.sub("[\n \xa0]", "", "".join(page.strings()))
    metas = {n.attrs.get("name", ""): n.attrs.get("content") for n in page.all("meta")}
    meta = lambda part: next((v for k, v in reversed(metas.items()) if part and part in k), None)
    problem = None
    if detail.within:
        where, wanted, unwanted, there = detail.within
        sign = _first(page.walk(), lambda n: n.has_class(where))
        shown = "".join(sign.strings()) if sign else ""
        if sign is None and there or sign is not None and (wanted and wanted not in shown or unwanted and re.search(unwanted, shown)):
            problem = "detail_scope_leak"
    named = [re.search(detail.number_in_title, t) for t in (title, "".join(page.strings()))] if detail.number_in_title else []
    number = _after(text, detail.number) or meta(detail.number_meta) or next((m.group(1) for m in named if m), None)
    dated = meta(detail.date_meta) or _after(text, detail.date)
    if dated and "年" in dated:
        dated = re.sub("[年月]", "-", dated).removesuffix("日")
    problem = problem or (None if number else "missing_document_number") or (None if dated else "missing_publication_date")
    extra = {name: v for name, what in detail.extra if (v := _after(text, what))}
    return {"source_item_id": number, "title": meta(detail.title_meta) or title, "published_at_raw": dated, "raw_metadata": extra, "problem": problem}


# Spark -------------------------------------------------------------------------------------------
def _pages(source_id: pd.Series, body: pd.Series, base: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_page(LAYOUTS[s], b, u) for s, b, u in zip(source_id, body, base, strict=True)], columns=["items", "next_url", "faulty", "problem"])


def _facts(source_id: pd.Series, body: pd.Series, title: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_detail(LAYOUTS[s].detail, b, t) for s, b, t in zip(source_id, body, title, strict=True)], columns=["source_item_id", "title", "published_at_raw", "raw_metadata", "problem"])


def read(pages: DataFrame) -> DataFrame:
    """pages (source_id, base_url, body; sources without a layout are left out) with their items, next page, faulty rows and problem."""
    ship(pages.sparkSession)
    known = pages.filter(F.col("source_id").isin(*LAYOUTS))
    return known.withColumn("_p", F.pandas_udf(_pages, PAGE)("source_id", "body", "base_url")).select(*[c for c in pages.columns if c != "body"], "_p.items", "_p.next_url", "_p.faulty", "_p.problem")


def items(read_pages: DataFrame) -> DataFrame:
    """One row an item of the usable pages; seq is its place."""
    rows = read_pages.filter("problem is null").select("source_id", "base_url", F.posexplode("items").alias("seq", "i"))
    return rows.select("source_id", "base_url", "seq", "i.*")


def with_details(listed: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, rejects) of sites whose numbers and dates stand on the articles' pages; details (url, body), one row a URL.

    Items of other sites pass unchanged.  An item without its page, or whose page lacks a part, is rejected.
    """
    ship(listed.sparkSession)
    two_step = [s for s, layout in LAYOUTS.items() if layout.detail]
    plain = listed.filter(~F.col("source_id").isin(*two_step))
    d = details.select(F.col("url").alias("_url"), F.col("body").alias("_body"))
    both = listed.filter(F.col("source_id").isin(*two_step)).join(d, F.col("url") == F.col("_url"), "left")
    both = both.withColumn("_f", F.when(F.col("_url").isNotNull(), F.pandas_udf(_facts, FACTS)("source_id", "_body", "title")))
    both = both.withColumn("_problem", F.when(F.col("_url").isNull(), "missing_detail_page").otherwise(F.col("_f.problem")))
    new = {"source_item_id", "title", "published_at_raw"}
    good = both.filter("_problem is null").select(*[F.col(f"_f.{c}").alias(c) if c in new else F.map_concat("raw_metadata", "_f.raw_metadata").alias(c) if c == "raw_metadata" else F.col(c) for c in listed.columns])
    return plain.unionByName(good), both.filter("_problem is not null").select("source_id", "url", F.col("_problem").alias("reason"))
