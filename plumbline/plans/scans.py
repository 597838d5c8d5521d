"""Queries of the sources: payloads are made from the tables, read by the operators, and SQL says what they hold."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.plans.catalogue import _query, _seconds
from plumbline.session import shared_folder, table
from plumbline.sources import catalogues, feeds, listings, windows

#: Documents of one payload.
PAYLOAD = 40


def _payloads(spark, sf_dir, entry, head="", tail="", between=""):
    """pid and body: the entries of PAYLOAD documents in order, each a text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").withColumn("pid", F.expr(f"doc_id div {PAYLOAD}"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce(entry, F.lit("")).alias("x")))), lambda e: e["x"]), between)  # PAYLOAD entries
    return docs.groupBy("pid").agg(F.concat(F.lit(head), joined, F.lit(tail)).alias("body"))


_DOCS = f"SELECT doc_id, source, lang, n_chars, doc_id // {PAYLOAD} AS pid, row_number() OVER (PARTITION BY doc_id // {PAYLOAD} ORDER BY doc_id) - 1 AS seq FROM documents"


def _id():
    return F.col("doc_id").cast("string")


def _feeds(spark, sf_dir):
    """Four kinds of payloads: Atom, RSS that breaks off, something else, RSS."""
    c, n = F.concat, F.col("n_chars").cast("string")
    title = c(F.lit("<title>"), F.col("source"), F.lit(" &amp; "), F.col("lang"), F.lit("</title>"))
    late = F.col("n_chars") % 2 == 0
    rss = c(F.lit("<item><guid>id"), _id(), F.lit("</guid>"), F.when(F.col("doc_id") % 9 != 0, c(F.lit("<link>https://h/"), _id(), F.lit("</link>"))).otherwise(F.lit("")), title, F.when(late, c(F.lit("<updated>u"), n, F.lit("</updated>"))).otherwise(c(F.lit("<pubDate>p"), n, F.lit("</pubDate>"))), F.lit("</item>"))
    atom = c(F.lit("<entry><id>id"), _id(), F.lit('</id><link rel="self" href="https://self/"/>'), F.when(F.col("doc_id") % 9 != 0, c(F.lit('<link href="https://h/'), _id(), F.lit('"/>'))).otherwise(F.lit("")), title, F.when(late, c(F.lit("<updated>u"), n, F.lit("</updated>"))).otherwise(c(F.lit("<published>p"), n, F.lit("</published><updated>x</updated>"))), F.lit("</entry>"))
    both = _payloads(spark, sf_dir, F.when(F.col("pid") % 4 == 0, atom).otherwise(rss))
    kind = F.col("pid") % 4
    body = F.when(kind == 0, c(F.lit('<?xml version="1.0"?><feed>'), "body", F.lit("</feed>"))).when(kind == 1, c(F.lit("<rss><channel>"), "body", F.lit("<item><title>cut"))).when(kind == 2, F.lit("no feed at all")).otherwise(c(F.lit("<rss><channel>"), "body", F.lit("</channel></rss>")))
    return feeds.feed(both.withColumn("body", body))


@_query(f"""SELECT pid, seq, 'id' || doc_id AS source_item_id, 'https://h/' || doc_id AS url, source || ' & ' || lang AS title, CASE WHEN n_chars % 2 = 0 THEN 'u' ELSE 'p' END || n_chars AS published_at_raw FROM ({_DOCS}) WHERE pid % 4 <> 2 AND doc_id % 9 <> 0""")
def feed_scan(spark, sf_dir):
    return _feeds(spark, sf_dir)[0].select("pid", "seq", "source_item_id", "url", "title", "published_at_raw")


@_query(f"""SELECT pid, CASE WHEN pid % 4 <> 2 THEN count(*) END AS entries, CASE WHEN pid % 4 <> 2 THEN count(*) FILTER (WHERE doc_id % 9 = 0) END AS unusable, CASE WHEN pid % 4 = 2 THEN 'not a feed' END AS problem FROM ({_DOCS}) GROUP BY pid""")
def feed_problems(spark, sf_dir):
    return _feeds(spark, sf_dir)[1].select("pid", F.col("entries").cast("long").alias("entries"), F.col("unusable").cast("long").alias("unusable"), "problem")


def _rest(spark, sf_dir):
    url = F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit("https://h/"), _id()))
    entry = F.to_json(F.struct(F.concat(F.lit("n"), _id()).alias("document_number"), url.alias("html_url"), F.when(F.col("doc_id") % 4 == 0, F.lit(" ")).otherwise(F.col("source")).alias("title"), F.col("lang").alias("abstract"), F.col("n_chars").alias("publication_date")))
    pages = _payloads(spark, sf_dir, entry, between=",")
    kind = F.col("pid") % 6
    body = F.when(kind == 0, F.lit("oops")).when(kind == 1, F.lit("[1]")).when(kind == 2, F.lit('{"results": 5}')).when(kind == 3, F.lit('{"results": [], "next_page_url": "https://h/next"}'))
    return feeds.rest_pages(pages.withColumn("body", body.otherwise(F.concat(F.lit('{"next_page_url":"https://h/p'), F.col("pid").cast("string"), F.lit('","results":['), "body", F.lit("]}")))))


@_query(f"SELECT pid, seq, 'n' || doc_id AS source_item_id, 'https://h/' || doc_id AS url, CASE WHEN doc_id % 4 <> 0 THEN source END AS title, lang AS description, CAST(NULL AS VARCHAR) AS published_at_raw FROM ({_DOCS}) WHERE pid % 6 > 3 AND doc_id % 9 <> 0")
def rest_scan(spark, sf_dir):
    """A date that isn't text is unknown."""
    return _rest(spark, sf_dir)[0].select("pid", "seq", "source_item_id", "url", "title", "description", "published_at_raw")


@_query(f"""SELECT pid, CASE WHEN pid % 6 = 3 THEN 0 WHEN pid % 6 > 3 THEN count(*) END AS entries, CASE WHEN pid % 6 = 3 THEN 0 WHEN pid % 6 > 3 THEN count(*) FILTER (WHERE doc_id % 9 = 0) END AS unusable,
CASE pid % 6 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' WHEN 2 THEN 'no list of results' END AS problem, CASE WHEN pid % 6 > 3 THEN 'https://h/p' || pid END AS next_url FROM ({_DOCS}) GROUP BY pid""")
def rest_problems(spark, sf_dir):
    return _rest(spark, sf_dir)[1].select("pid", F.col("entries").cast("long").alias("entries"), F.col("unusable").cast("long").alias("unusable"), "problem", "next_url")


_PAGED = "SELECT c_custkey AS k, c_custkey % 13 AS m, 3 + c_custkey % 12 AS p, c_custkey % 5 AS f FROM customer"


@_query(f"""SELECT k AS source_id, i AS page, 'https://h' || k || '.org/list?p=' || i AS url, CAST(CASE WHEN i <= m AND i < 10 THEN 10 ELSE 0 END AS BIGINT) AS n_items,
CASE WHEN i = 10 THEN 'too many pages' WHEN i = m + 1 THEN 'a page that isn''t there' WHEN i = m AND i < p - 1 THEN CASE f WHEN 1 THEN 'not https' WHEN 2 THEN 'a loop' WHEN 3 THEN 'another origin' END END AS problem
FROM (SELECT *, unnest(range(least(m + CASE WHEN f = 4 THEN 1 ELSE 0 END, p - 1, 10) + 1)) AS i FROM ({_PAGED}))""")
def listing_paging(spark, sf_dir):
    """Chains of stored pages, most of which end in a next page that may not be fetched."""
    k = F.col("c_custkey")
    base = F.concat(F.lit("https://h"), k.cast("string"), F.lit(".org/list?p="))
    sources = table(spark, sf_dir, "customer").select(k.alias("source_id"), base.alias("base"), (k % 13).alias("m"), (k % 5).alias("f"), F.concat(base, F.lit("0")).alias("endpoint"), (10 * (3 + k % 12)).alias("max_items"))
    at = lambda n: F.concat("base", n.cast("string"))
    last = F.when(F.col("f") == 1, F.lit("http://h.org/list?p=1")).when(F.col("f") == 2, at(F.lit(0))).when(F.col("f") == 3, F.lit("https://other.org/list?p=9")).when(F.col("f") == 4, at(F.col("m") + 1))
    pages = sources.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long"))).alias("i")).select("source_id", at(F.col("i")).alias("url"), F.when(F.col("i") < F.col("m"), at(F.col("i") + 1)).otherwise(last).alias("next_url"), F.lit(10).alias("n_items"))
    return feeds.follow(pages, sources.select("source_id", "endpoint", "max_items"))


@_query(f"""SELECT pid, celex, 'https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:' || celex AS url, title, work, is_corrigendum FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY seq) AS k FROM
(SELECT pid, seq, CASE doc_id % 3 WHEN 0 THEN '32024R' || doc_id ELSE '32024L' || doc_id || 'R(01)' END AS celex, source AS title, 'w' || doc_id AS work, doc_id % 3 = 1 AS is_corrigendum FROM ({_DOCS}) WHERE doc_id % 3 <> 2 AND doc_id % 10 <> 0 AND pid % 4 <> 3)) WHERE k <= 8""")
def sparql_scan(spark, sf_dir):
    c = F.concat
    celex = F.when(F.col("doc_id") % 3 == 0, c(F.lit("32024R"), _id())).when(F.col("doc_id") % 3 == 1, c(F.lit("32024L"), _id(), F.lit("R(01)"))).otherwise(c(F.lit("52024X"), _id()))
    value = lambda x: F.struct(x.alias("value"))
    entry = F.to_json(F.struct(value(celex).alias("celex"), value(c(F.lit("w"), _id())).alias("work"), value(F.when(F.col("doc_id") % 10 == 0, F.lit(" ")).otherwise(F.col("source"))).alias("title")))
    body = F.when(F.col("pid") % 4 == 3, F.lit('{"results":{"bindings":[{"work":{"value":"no celex"}}]}}')).otherwise(F.concat(F.lit('{"results":{"bindings":['), "body", F.lit("]}}")))
    acts, _ = feeds.sparql(_payloads(spark, sf_dir, c(entry, F.lit(","), entry), between=",").withColumn("body", body), limit=8)
    return acts.select("pid", "celex", "url", "title", F.col("raw_metadata")["cellar_work_uri"].alias("work"), "is_corrigendum")


@_query("SELECT 'PLAW-' || n_nationkey AS source_item_id, 'https://www.govinfo.gov/app/details/PLAW-' || n_nationkey AS url, n_name AS title, 'd' || n_regionkey AS published_at_raw FROM nation")
def corpus_scan(spark, sf_dir):
    """Lists of packages, five a page, of which each page repeats the one before's last; and their details."""
    nation = table(spark, sf_dir, "nation").withColumn("id", F.concat(F.lit("PLAW-"), F.col("n_nationkey").cast("string")))
    total = nation.count()
    shown = nation.select("id", F.explode(F.array(F.expr("n_nationkey div 5"), F.expr("(n_nationkey + 1) div 5"))).alias("page")).distinct()
    pages = shown.groupBy("page").agg(F.to_json(F.struct(F.lit(total).alias("count"), F.transform(F.array_sort(F.collect_list("id")), lambda x: F.struct(x.alias("packageId"))).alias("packages"))).alias("body"))
    details = nation.select(F.col("id").alias("package_id"), F.to_json(F.struct(F.col("id").alias("packageId"), F.lit("PLAW").alias("collectionCode"), F.concat(F.lit(" "), "n_name").alias("title"), F.concat(F.lit("d"), F.col("n_regionkey").cast("string")).alias("dateIssued"))).alias("body"))
    return feeds.corpus_articles(feeds.corpus_list(pages), details).select("source_item_id", "url", "title", "published_at_raw")


@_query(f"SELECT pid AS query_id, row_number() OVER (PARTITION BY pid ORDER BY seq) - 1 AS seq, 'http://a/' || doc_id AS original_url, CASE WHEN doc_id % 4 <> 0 THEN source END AS title, lang AS language_hint, CAST(n_chars AS VARCHAR) AS seen FROM ({_DOCS}) WHERE doc_id % 9 <> 0 AND pid % 5 <> 4")
def discovery_scan(spark, sf_dir):
    entry = F.to_json(F.struct(F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit(" http://a/"), _id())).otherwise(F.lit(" ")).alias("url"), F.when(F.col("doc_id") % 4 == 0, F.lit(" ")).otherwise(F.col("source")).alias("title"), F.col("lang").alias("language"), F.col("n_chars").cast("string").alias("seendate")))
    body = F.when(F.col("pid") % 5 == 4, F.lit("{}")).otherwise(F.concat(F.lit('{"articles":['), "body", F.lit("]}")))
    responses = _payloads(spark, sf_dir, entry, between=",").select(F.col("pid").alias("query_id"), F.lit("2026-07-01").alias("observed_at"), body.alias("body"))
    found, _ = feeds.discovery(responses)
    return found.select("query_id", "seq", "original_url", "title", "language_hint", F.col("provider_metadata")["provider_seendate"].alias("seen"))


_CELLS = "e AS (SELECT event_type AS cell, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events), c AS (SELECT cell, min(sec) AS s, max(sec) + 1 AS e FROM e GROUP BY cell)"


@_query(f"""WITH RECURSIVE {_CELLS}, w AS (SELECT cell, 0 AS depth, s, e, (SELECT count(*) FROM e WHERE e.cell = c.cell AND sec >= s AND sec < c.e) AS n FROM c
UNION ALL SELECT cell, depth + 1, ns, ne, (SELECT count(*) FROM e WHERE e.cell = h.cell AND sec >= ns AND sec < ne) FROM (SELECT w.cell, depth, CASE WHEN i = 0 THEN s ELSE s + (w.e - s) // 2 END AS ns, CASE WHEN i = 0 THEN s + (w.e - s) // 2 + 1 ELSE w.e END AS ne
FROM w, (VALUES (0), (1)) v(i) WHERE n >= 250 AND depth < 6 AND w.e - s > 60 AND s + (w.e - s) // 2 + 1 < w.e) h)
SELECT cell, depth, s AS "start", e AS "end", least(n, 250) AS records, n < 250 OR (depth < 6 AND e - s > 60 AND s + (e - s) // 2 + 1 < e) AS complete FROM w""")
def window_plan(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("cell"), _seconds("ts").alias("at"))
    cells = events.groupBy("cell").agg(F.min("at").alias("start"), (F.max("at") + 1).alias("end"))
    return windows.plan(events, cells)


# Listings ----------------------------------------------------------------------------------------
def _row(*cells):
    return F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td>"), c if not isinstance(c, str) else F.lit(c), F.lit("</td>"))], F.lit("</tr>"))


_SITES = ["vn_sbv_regulatory_docs", "vn_moit_regulatory_docs", "vn_mst_regulatory_docs", "us_fhfa_regulatory", "eu_esma_regulatory", "cn_samr_market_regulation_bulletins", "cn_miit_policy_listing", "us_bis_regulatory"]


def _listings(spark, sf_dir):
    """A page of each of eight layouts in turn, a row a document."""
    c, say = F.concat, lambda before, after="": F.concat(F.lit(before), _id(), F.lit(after))
    entries = [
        c(F.lit('<li><a class="title-news-link" href="/a'), _id(), say("?redirect=z&k=1\"> Số ", "/2026/TT-NHNN về </a>"), F.lit('<span class="date-about">01/07/2026</span></li>')),
        _row("1", say("Title "), say("Số: ", "/2026/TT-BCT"), say("02/07/2026<a href='/d", "'></a>")),
        _row(say("", "/QD"), "I", "T", "F", say("Name <a href='/van-ban-phap-luat/", ".htm'>Xem chi tiết</a>"), "03/07/2026"),
        _row("07/13/2026", say("T"), "N", "Rule", c(F.lit("91 FR 1<a href='https://www.federalregister.gov/documents/2026/07/13/2026-"), _id(), say("/x'>f</a><a href='/regulation/federal-register/t", "'>d</a>"))),
        _row("13/07/2026", say("ESMA75-1-"), say("T"), F.when(F.col("doc_id") % 3 == 0, "Other").otherwise("Guidelines and Technical standards"), "Report", say("<a href='/document/t", "'>x</a>")),
        c(F.lit('<li><a href="http://www.samr.gov.cn/x/art/'), F.concat(F.lit("art_"), F.md5(_id())), say('.html" title="甲', '">乙</a><span>[2026-07-01]</span></li>')),
        c(F.lit('<li><a href="https://www.miit.gov.cn/zwgk/zcwj/'), F.concat(F.lit("art_"), F.md5(_id())), say('.html">丙', '</a><span>2026-07-02</span></li>')),
        F.to_json(F.struct(say("T").alias("frnTitle"), F.struct(c(F.lit("https://www.federalregister.gov/documents/2026/07/01/2026-"), _id(), F.lit("/t")).alias("url")).alias("frnUrl"), F.struct(F.lit("p").alias("time")).alias("frnPublicationDate"))),
    ]
    kind = F.col("pid") % len(entries)
    entry = F.coalesce(*[F.when(kind == k, e) for k, e in enumerate(entries)])
    around = {0: ('<div class="danh-sach-tin-tuc-v32">', "</div>"), 6: ('<div class="tabbox-hd"><a>政策文件</a></div><div class="tabbox-bd"><div>', "</div></div>"), 7: ('<script id="__NEXT_DATA__" type="application/json">{"props":{"frns":[', "{}]}}</script>")}
    pages = _payloads(spark, sf_dir, F.when(kind == 7, F.concat(entry, F.lit(","))).otherwise(entry))
    body = F.coalesce(*[F.when(kind == k, F.concat(F.lit(a), "body", F.lit(b))) for k, (a, b) in around.items()], "body")
    site = F.element_at(F.array(*map(F.lit, _SITES)), (kind + 1).cast("int"))
    return pages.select(site.alias("source_id"), F.concat(F.lit("https://h.org/list/"), F.col("pid").cast("string")).alias("base_url"), body.alias("body"))


@_query(f"""SELECT ([{', '.join(f"'{s}'" for s in _SITES)}])[CAST(k + 1 AS INT)] AS source_id, pid, CASE k WHEN 0 THEN 'https://h.org/a' || doc_id || '?k=1' WHEN 1 THEN 'https://h.org/d' || doc_id WHEN 2 THEN 'https://h.org/van-ban-phap-luat/' || doc_id || '.htm' WHEN 3 THEN 'https://h.org/regulation/federal-register/t' || doc_id
WHEN 4 THEN 'https://h.org/document/t' || doc_id WHEN 5 THEN 'https://www.samr.gov.cn/x/art/art_' || md5(CAST(doc_id AS VARCHAR)) || '.html' WHEN 6 THEN 'https://www.miit.gov.cn/zwgk/zcwj/art_' || md5(CAST(doc_id AS VARCHAR)) || '.html' ELSE 'https://www.federalregister.gov/documents/2026/07/01/2026-' || doc_id || '/t' END AS url,
CASE k WHEN 0 THEN doc_id || '/2026/TT-NHNN' WHEN 1 THEN doc_id || '/2026/TT-BCT' WHEN 2 THEN CAST(doc_id AS VARCHAR) WHEN 3 THEN '2026-' || doc_id WHEN 4 THEN 'ESMA75-1-' || doc_id WHEN 7 THEN '2026-' || doc_id ELSE 'art_' || md5(CAST(doc_id AS VARCHAR)) END AS source_item_id,
CASE k WHEN 0 THEN 'Số ' || doc_id || '/2026/TT-NHNN về' WHEN 1 THEN 'Title ' || doc_id WHEN 2 THEN 'Name' WHEN 5 THEN '甲' || doc_id WHEN 6 THEN '丙' || doc_id ELSE 'T' || doc_id END AS title,
CASE k WHEN 0 THEN '01/07/2026' WHEN 1 THEN '02/07/2026' WHEN 2 THEN '03/07/2026' WHEN 3 THEN '07/13/2026' WHEN 4 THEN '13/07/2026' WHEN 5 THEN '2026-07-01' WHEN 6 THEN '2026-07-02' ELSE 'p' END AS published_at_raw
FROM (SELECT *, pid % 8 AS k FROM ({_DOCS})) WHERE NOT (k = 4 AND doc_id % 3 = 0)""")
def listing_layouts(spark, sf_dir):
    read = listings.items(listings.read(_listings(spark, sf_dir)))
    return read.select("source_id", F.regexp_extract("base_url", r"(\d+)$", 1).cast("long").alias("pid"), "url", "source_item_id", F.trim("title").alias("title"), "published_at_raw")


def _two_step(spark, sf_dir):
    """Pages of four sites whose numbers and dates stand on the articles' own pages, some of which are missing or show another channel."""
    c = F.concat
    links = [
        c(F.lit('<a href="https://www.gov.cn/zhengce/content/'), _id(), F.lit('.htm">甲'), _id(), F.lit("</a>")),
        c(F.lit('<a href="/tiaofasi/144941/144957/2026'), F.lpad(_id(), 8, "0"), F.lit('/index.html">中国人民银行令〔2026〕第'), _id(), F.lit("号</a>")),
        c(F.lit('<a href="/csrc/c101954/'), _id(), F.lit('/content.shtml">一份很长的标题'), _id(), F.lit("</a>")),
        c(F.lit('<a href="/2026/'), _id(), F.lit('/c.html">丁'), _id(), F.lit("</a>")),
    ]
    facts = [
        c(F.lit("<p>发文字号：</p><p>国发〔2026〕"), _id(), F.lit("号</p><p>成文日期： 2026年7月1日</p>")),
        F.lit('<meta name="PubDate" content="2026-07-01"><div class="Position">部门规章</div>'),
        c(F.lit('<meta name="ArticleTitle" content="全名'), _id(), F.lit('"><p>索引号 bm56000001/2026-'), _id(), F.lit("</p><p>发文日期 2026年7月2日</p>")),
        c(F.when(F.col("doc_id") % 4 == 0, F.lit('<div class="nav">解读</div>')).otherwise(F.lit("")), F.lit("<p>索引号：000019705/2026-"), _id(), F.lit(" 制发日期：2026-07-03</p>")),
    ]
    sites = ["cn_state_council_policy_docs", "cn_pboc_regulatory_docs", "cn_csrc_regulatory_docs", "cn_nea_regulatory_docs"]
    roots = ["https://www.gov.cn/", "https://www.pbc.gov.cn/", "https://www.csrc.gov.cn/", "https://www.nea.gov.cn/"]
    around = [("", ""), ('<div class="Position">部门规章</div>', ""), ("<title>证监会公告</title>", ""), ("<div><h3>通知</h3>", "</div>")]
    kind = F.col("pid") % 4
    pick = lambda xs: F.coalesce(*[F.when(kind == k, x if not isinstance(x, str) else F.lit(x)) for k, x in enumerate(xs)])
    pages = _payloads(spark, sf_dir, pick(links))
    pages = pages.select(pick(sites).alias("source_id"), pick(roots).alias("base_url"), c(pick([a for a, _ in around]), "body", pick([b for _, b in around])).alias("body"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(f"doc_id div {PAYLOAD}").alias("pid"))
    url = pick([c(F.lit("https://www.gov.cn/zhengce/content/"), _id(), F.lit(".htm")), c(F.lit("https://www.pbc.gov.cn/tiaofasi/144941/144957/2026"), F.lpad(_id(), 8, "0"), F.lit("/index.html")), c(F.lit("https://www.csrc.gov.cn/csrc/c101954/"), _id(), F.lit("/content.shtml")), c(F.lit("https://www.nea.gov.cn/2026/"), _id(), F.lit("/c.html"))])
    details = docs.filter("doc_id % 5 <> 0").select(url.alias("url"), pick(facts).alias("body"))
    return listings.with_details(listings.items(listings.read(pages)), details)


@_query(f"""SELECT ['cn_state_council_policy_docs', 'cn_pboc_regulatory_docs', 'cn_csrc_regulatory_docs', 'cn_nea_regulatory_docs'][CAST(k + 1 AS INT)] AS source_id, CASE WHEN reason IS NULL THEN CASE k WHEN 0 THEN '国发〔2026〕' || doc_id || '号' WHEN 1 THEN '中国人民银行令〔2026〕第' || doc_id || '号' WHEN 2 THEN 'bm56000001/2026-' || doc_id ELSE '000019705/2026-' || doc_id END END AS source_item_id,
CASE WHEN reason IS NULL THEN CASE k WHEN 0 THEN '2026-7-1' WHEN 1 THEN '2026-07-01' WHEN 2 THEN '2026-7-2' ELSE '2026-07-03' END END AS published_at_raw, reason, count(*) AS n
FROM (SELECT doc_id, k, CASE WHEN doc_id % 5 = 0 THEN 'missing_detail_page' WHEN k = 3 AND doc_id % 4 = 0 THEN 'detail_scope_leak' END AS reason FROM (SELECT doc_id, pid % 4 AS k FROM ({_DOCS}))) GROUP BY ALL""")
def listing_details(spark, sf_dir):
    good, bad = _two_step(spark, sf_dir)
    none = F.lit(None).cast("string")
    both = good.select("source_id", "source_item_id", "published_at_raw", none.alias("reason")).unionByName(bad.select("source_id", none.alias("source_item_id"), none.alias("published_at_raw"), "reason"))
    return both.groupBy("source_id", "source_item_id", "published_at_raw", "reason").agg(F.count("*").alias("n"))


# Catalogues --------------------------------------------------------------------------------------
def _written(spark, **files: str) -> str:
    """A folder of the shared one that holds these texts."""
    folder = os.path.join(shared_folder(spark), f"catalogue-{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name, content in files.items():
        path = hadoop.Path(f"{folder}/{name}.toml")
        out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path)
        out.write(bytearray(content.encode()))
        out.close()
    return folder


_SOURCE = """source_id = "{0}"
name = "N"
market = "{1}"
language = "en"
source_type = "GOVERNMENT"
authority_level = "PRIMARY"
domains = ["FINANCE"]
priority = {2}
content_scope = "EDITORIAL_NEWS"
[acquisition]
method = "RSS"
endpoint_url = "https://h/feed"
poll_interval_minutes = 15
[rights]
can_fetch = true
can_store_metadata = {3}
can_store_full_text = "REVIEWED"
can_ai_process = false
can_show_snippet = true
can_redistribute_full_text = false
rights_review_status = "APPROVED"
[cost]
type = "FREE"
monthly_fixed_usd = 0
"""
_AUTHORED = [("a_high", "US", 9, "false"), ("b_low", "VN", 1, "true"), ("c_mid", "EU", 5, "true")]


def _sources(spark):
    return catalogues.sources(spark, _written(spark, **{s[0]: _SOURCE.format(*s) for s in _AUTHORED}))


@_query("SELECT * FROM (VALUES ('a_high', 'US', 9, false, 'FINANCE'), ('b_low', 'VN', 1, true, 'FINANCE'), ('c_mid', 'EU', 5, true, 'FINANCE')) v(source_id, market, priority, can_store_metadata, domains)")
def source_catalogue(spark, sf_dir):
    return _sources(spark).select("source_id", "market", "priority", "can_store_metadata", F.array_join("domains", ",").alias("domains"))


@_query("SELECT * FROM (VALUES ('q1', 'P', 'US', 'FINANCE', 'x'), ('q2', 'P', 'VN', 'ENERGY', 'y')) v(query_id, provider, market, domain, query_expression)")
def query_catalogue(spark, sf_dir):
    one = '[[queries]]\nquery_id = "{}"\nprovider = "P"\nmarket = "{}"\ndomain = "{}"\nquery_expression = "{}"\n'
    folder = _written(spark, queries=one.format("q1", "US", "FINANCE", "x") + one.format("q2", "VN", "ENERGY", "y"))
    return catalogues.queries(spark, f"{folder}/queries.toml").select("query_id", "provider", "market", "domain", "query_expression")


@_query("SELECT * FROM (VALUES ('h.org', '/a', 'b_low', 'CANONICAL_URL_FALLBACK'), ('h.org', '/ab', 'c_mid', 'NATIVE_SOURCE_ITEM_ID_REQUIRED')) v(hostname, path_prefix, target_source_id, identity_mode)")
def route_catalogue(spark, sf_dir):
    one = '[[routes]]\nhostname = "h.org"\npath_prefix = "{}"\ntarget_source_id = "{}"\ncontent_scope = "X"\nidentity_mode = "{}"\n'
    folder = _written(spark, routes=one.format("/a", "b_low", "CANONICAL_URL_FALLBACK") + one.format("/ab", "c_mid", "NATIVE_SOURCE_ITEM_ID_REQUIRED"))
    return catalogues.routes(spark, f"{folder}/routes.toml", _sources(spark)).select("hostname", "path_prefix", "target_source_id", "identity_mode")


@_query("SELECT * FROM (VALUES ('flat', 'm', 'all', 1767225600, 1769904000, 0, 1440, 0.1, 0.3), ('peak', 'm', 'night', 1769904000, NULL, 0, 60, 0.2, 0.6), ('peak', 'm', 'day', 1769904000, NULL, 60, 1440, 0.4, 1.2)) v(pricing_id, model, \"window\", effective_from, effective_until, start_minute, end_minute, hit_rate, output_rate)")
def price_catalogue(spark, sf_dir):
    schedule = '[[schedules]]\npricing_id = "{}"\nmodel = "m"\neffective_from = {}\n{}\n'
    window = '[[schedules.windows]]\nname = "{}"\nstart_minute_utc = {}\nend_minute_utc = {}\ninput_cache_hit_usd_per_million = "{}"\ninput_cache_miss_usd_per_million = "1"\noutput_usd_per_million = "{}"\n'
    text = schedule.format("flat", "2026-01-01T00:00:00Z", "effective_until = 2026-02-01T00:00:00Z") + window.format("all", 0, 1440, "0.1", "0.3") + schedule.format("peak", "2026-02-01T00:00:00Z", "") + window.format("day", 60, 1440, "0.4", "1.2") + window.format("night", 0, 60, "0.2", "0.6")
    found = catalogues.prices(spark, f"{_written(spark, prices=text)}/prices.toml")
    return found.select("pricing_id", "model", "window", "effective_from", "effective_until", "start_minute", "end_minute", F.col("hit_rate").cast("double").alias("hit_rate"), F.col("output_rate").cast("double").alias("output_rate"))


@_query("SELECT * FROM (VALUES ('ENERGY', 'ENERGY policy', 'ENERGY words'), ('FINANCE', 'FINANCE policy', 'FINANCE words'), ('LAW_POLICY', 'LAW_POLICY policy', 'LAW_POLICY words'), ('REAL_ESTATE', 'REAL_ESTATE policy', 'REAL_ESTATE words'), ('TECHNOLOGY', 'TECHNOLOGY policy', 'TECHNOLOGY words')) v(category, strong, description)")
def rule_catalogue(spark, sf_dir):
    text = "[thresholds]\nmin_category_score = 4\nmin_category_margin = 2\nmin_market_score = 2\n"
    text += "".join(f'[[categories]]\ncategory = "{d}"\nstrong_title = ["{d} policy"]\ntitle_keywords = ["{d}"]\ndescription_keywords = ["{d} words"]\n' for d in catalogues.DOMAINS)
    text += "".join(f'[[markets]]\nmarket = "{m}"\ntitle_keywords = ["{m}"]\ndescription_keywords = ["{m} words"]\n' for m in catalogues.MARKETS) + "".join(f'[[topics]]\ntopic = "{t}"\nkeywords = ["{t}"]\n' for t in catalogues.TOPICS)
    rules = catalogues.rules(spark, _written(spark, rules=text), lambda w: w)
    return spark.createDataFrame([(c.name, c.strong_title[0], c.description[0]) for c in rules.categories], "category string, strong string, description string")


@_query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation")
def sample_records(spark, sf_dir):
    """Sample files of both forms: bare arrays, and objects that hold records."""
    rows = table(spark, sf_dir, "nation").select((F.col("n_regionkey")).alias("f"), F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")).alias("r"))
    lists = rows.groupBy("f").agg(F.to_json(F.collect_list("r")).alias("x"))
    texts = lists.select(F.when(F.col("f") % 2 == 0, F.col("x")).otherwise(F.concat(F.lit('{"sample_notice":"s","records":'), "x", F.lit("}"))).alias("value"))
    folder = os.path.join(shared_folder(spark), f"samples-{uuid.uuid4().hex}")
    texts.repartition(texts.count()).write.text(folder)
    return catalogues.records(spark, f"{folder}/part-*", "id string, name string")


@_query(r"""SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
 '</?(address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|figure|footer|h[1-6]|header|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)(\s[^>]*)?/?>', ' ', 'g'), '<[!/a-zA-Z][^>]*>', '', 'g'),
 '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&#x27;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&amp;', '&'), '[\x20\x09-\x0D]+', ' ', 'g')), '') AS text FROM pages""")
def html_visible_text(spark, sf_dir):
    """Only references that a semicolon closes are decoded, as the SQL does; titles of some pages are cut within one."""
    return table(spark, sf_dir, "pages").select("page_id", T.visible_text_of_closed(F.col("html")).alias("text"))
