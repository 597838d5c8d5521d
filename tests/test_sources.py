from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import normalize
from plumbline.sources import catalogues, feeds, listings, windows
from plumbline.streaming import sinks


def test_feeds(spark):
    def read(reader, *bodies, **more):
        articles, told = reader(spark.createDataFrame([(f"s{k}", b) for k, b in enumerate(bodies)], "source_id string, body string"), **more)
        return sorted(articles.collect(), key=lambda r: (r["source_id"], r["seq"])), [r for r in told.orderBy("source_id").collect()]

    item = "<item><guid>1</guid><link>http://a/1</link><title>T</title><updated>u</updated></item>"
    got, told = read(feeds.feed, f"<rss><channel>{item}<item><title>no link</title></item><item><link> </link></item><item><link>http://a/2</link><pubDate>p</pubDate><updated>u</updated></item></channel></rss>")
    assert [(r["seq"], r["source_item_id"], r["url"], r["published_at_raw"]) for r in got] == [(0, "1", "http://a/1", "u"), (3, None, "http://a/2", "p")] and tuple(told[0])[1:] == (4, 2, None)
    entry = '<entry><id>x</id><link rel="self" href="http://self"/><link rel="alternate" href="http://a/3"/><title>T</title><summary>S</summary><updated>u</updated></entry>'
    got, told = read(feeds.feed, f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">{entry}</feed>', "not xml", "<html><p>x</p></html>", "<rss><channel></channel></rss>", f"<rss><channel>{item}<item><ti", "<rss><channel><item><title>x</title></item></channel></rss>", "<rss><channel>", None)
    assert [(r["source_id"], r["url"], r["description"], r["published_at_raw"]) for r in got] == [("s0", "http://a/3", "S", "u"), ("s4", "http://a/1", None, "u")]
    assert [(r["entries"], r["problem"]) for r in told] == [(1, None), (None, "not a feed"), (None, "not a feed"), (0, None), (1, None), (None, "no usable entry"), (None, "not a feed"), (None, "not a feed")]
    with pytest.raises(ValueError, match="not a feed"):
        feeds.checked(*feeds.feed(spark.createDataFrame([("s", "oops")], "source_id string, body string")))
    got, told = read(feeds.rest_pages, '{"count":2,"next_page_url":"n","results":[{"html_url":" http://a/4","title":" "},{"title":"x"},5]}', "oops", "[]", "{}", '{"results":[],"next_page_url":"n"}', '{"results":[{"html_url":5}]}')
    assert [(r["url"], r["title"]) for r in got] == [("http://a/4", None)]
    assert [tuple(r)[1:] for r in told] == [(3, 2, None, "n"), (None, None, "not JSON", None), (None, None, "not an object", None), (None, None, "no list of results", None), (0, 0, None, None), (None, None, "no usable entry", None)]
    b = lambda c, t: f'{{"celex":{{"value":"{c}"}},"work":{{"value":"w"}},"date":{{"value":"d"}},"title":{{"value":"{t}"}}}}'
    acts = '{"results":{"bindings":[' + ",".join([b("32024R0001", " "), b(" 32024R0001 ", "A"), b("32024R0001", "B"), b("52024X1", "C"), b("32024L0002R(01)", "D"), b("32024D3", "E")]) + "]}}"
    got, told = read(feeds.sparql, acts, '{"results":{}}', '{"results":{"bindings":[{"title":{"value":"x"}}]}}', '{"results":{"bindings":["x"]}}', limit=2)
    assert [(r["celex"], r["title"], r["is_corrigendum"], r["url"][-5:], r["raw_metadata"]) for r in got] == [("32024R0001", "A", False, "R0001", {"cellar_work_uri": "w", "document_date": "d"}), ("32024L0002R(01)", "D", True, "R(01)", {"cellar_work_uri": "w", "document_date": "d"})]
    assert [r["problem"] for r in told] == [None, "no list of bindings", "a broken binding", "a broken binding"]


def test_next_pages(spark):
    cases = [("https://h/l?p=2", None), ("http://h/l?p=2", "not https"), ("https://u:p@h/l", "a user name"), ("https://g/l", "another origin"), ("https://h/m", "another path"), ("https://h/l?p=1", "a loop"), ("https://h:8443/l", "another origin"), (None, None)]
    rows = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(cases)], "k int, u string")
    got = rows.select("k", feeds.next_page_problem(F.col("u"), F.lit("https://h/l"), F.array(F.lit("https://h/l?p=1"))).alias("p")).orderBy("k").collect()
    assert [r["p"] for r in got] == [p for _, p in cases]


def ask(cell: str, start: int, end: int) -> list[str]:
    """A provider with a record every other second, 250 at most a request."""
    return [f"{cell}{t}" for t in range(start, end) if t % 2 == 0][:250]


def test_cells_as_a_data_source(spark):
    spark.dataSource.register(windows.CellSource)
    import json

    rows = spark.read.format("plumbline_cells").option("cells", json.dumps([["a", 0, 1000], ["b", 0, 60], ["c", 0, 10]])).option("reader", "tests.test_sources:ask").option("cap", "20").load()
    got = {}
    for r in rows.collect():
        got.setdefault(r["cell"], []).append(r)
    assert rows.rdd.getNumPartitions() == 3 and len(got["c"]) == 5 and all(r["complete"] for r in got["c"]) and not any(r["complete"] for r in got["b"])
    assert [r["seq"] for r in got["a"]] == list(range(len(got["a"])))


def test_windows():
    times = list(range(0, 1000, 2))
    out = windows.fetch(0, 1000, lambda a, b: [t for t in times if a <= t < b][:250])
    assert out.complete and set(out.records) == set(times) and len(out.records) > len(times)
    assert not windows.fetch(0, 60, lambda a, b: [0] * 250).complete


def test_stream_appends_once(spark, tmp_path):
    """Batches that run again, as after a lost driver, add nothing; later ones see what earlier ones added."""
    batches = [[(1, "a"), (2, "a"), (3, "b")], [(4, "a"), (5, "c"), (6, "b")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "seq long, key string").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("seq long, key string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sinks.append_new(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["key"], "seq").awaitTermination()
    read = lambda: sorted((r["key"], r["seq"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    first = read()
    assert [k for k, _ in first] == ["a", "b", "c"]
    for k in (1, 0, 1):  # replays, out of order too
        sinks.add_new(spark.createDataFrame(batches[k], "seq long, key string"), k, f"{tmp_path}/again", ["key"], "seq")
    sinks.add_new(spark.createDataFrame(batches[0], "seq long, key string"), 0, f"{tmp_path}/again", ["key"], "seq")
    assert sorted((r["key"], r["seq"]) for r in spark.read.parquet(f"{tmp_path}/again").collect()) == [("a", 1), ("b", 3), ("c", 5)]


def test_contract_check(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "name string, n long")
    sinks.export_contract(rows, ["name", "n"], f"{tmp_path}/c")
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/c").collect()) == ['{"n":1,"name":"a"}', '{"n":null,"name":"b"}']
    assert sinks.export_contract(rows, ["name", "n"], f"{tmp_path}/c", check=True) == 0
    assert sinks.export_contract(rows.limit(1), ["name", "n"], f"{tmp_path}/c", check=True) == 1


SOURCE = """source_id = "{id}"
name = "N"
market = "US"
language = "en"
source_type = "GOVERNMENT"
authority_level = "PRIMARY"
domains = ["FINANCE"]
priority = {priority}
content_scope = "EDITORIAL_NEWS"
[acquisition]
method = "RSS"
endpoint_url = "https://h/feed"
poll_interval_minutes = 15
[rights]
can_fetch = true
can_store_metadata = {store}
can_store_full_text = "REVIEWED"
can_ai_process = false
can_show_snippet = true
can_redistribute_full_text = false
rights_review_status = "APPROVED"
[cost]
type = "FREE"
monthly_fixed_usd = {cost}
"""


def test_source_catalogue(spark, tmp_path):
    folder = tmp_path / "sources"
    folder.mkdir()
    with pytest.raises(Exception):
        catalogues.sources(spark, str(folder))
    (folder / "b_low.toml").write_text(SOURCE.format(id="b_low", priority=1, store="true", cost=0))
    (folder / "a_high.toml").write_text(SOURCE.format(id="a_high", priority=9, store="false", cost=0))
    found = catalogues.sources(spark, str(folder))
    assert [r["source_id"] for r in normalize.select_sources(found).collect()] == ["a_high", "b_low"]
    assert [r["source_id"] for r in normalize.eligible(found, "classification-v2").collect()] == ["b_low"]
    assert normalize.eligible(found, "classification-v1").isEmpty()
    with pytest.raises(ValueError):
        normalize.select_sources(found, ["a_high", "nobody"])
    route = '[[routes]]\nhostname = "{}"\npath_prefix = "{}"\ntarget_source_id = "b_low"\ncontent_scope = "X"\nidentity_mode = "CANONICAL_URL_FALLBACK"\n'
    assert catalogues.routes(spark, str(tmp_path / "none.toml"), found).isEmpty()
    (tmp_path / "r.toml").write_text(route.format("h.org", "/a") + route.format("h.org", "/ab"))
    assert catalogues.routes(spark, str(tmp_path / "r.toml"), found).count() == 2
    for more in (route.format("h.org", "/a/b"), route.format("H.org", "/c"), route.format("h.org", "c")):
        (tmp_path / "r2.toml").write_text(route.format("h.org", "/a") + more)
        with pytest.raises(catalogues.CatalogueError):
            catalogues.routes(spark, str(tmp_path / "r2.toml"), found)
    for bad in (SOURCE.format(id="other", priority=1, store="true", cost=0), SOURCE.format(id="c_bad", priority=1, store="true", cost=5), SOURCE.format(id="c_bad", priority=1, store="true", cost=0).replace('["FINANCE"]', '["FINANCE", "FINANCE"]')):
        (folder / "c_bad.toml").write_text(bad)
        with pytest.raises(catalogues.CatalogueError):
            catalogues.sources(spark, str(folder))


def test_query_and_price_catalogues(spark, tmp_path):
    one = '[[queries]]\nquery_id = "{}"\nprovider = "P"\nmarket = "US"\ndomain = "{}"\nquery_expression = "x"\n'
    path = str(tmp_path / "q.toml")
    assert catalogues.queries(spark, None).isEmpty()
    with pytest.raises(catalogues.CatalogueError):
        catalogues.queries(spark, path)
    for text, good in ((one.format("a", "FINANCE") + one.format("b", "ENERGY"), True), (one.format("a", "FINANCE") + one.format("b", "FINANCE"), False), (one.format("a", "FINANCE") + one.format("a", "ENERGY"), False), ("queries = []", False)):
        (tmp_path / "q.toml").write_text(text)
        if good:
            assert catalogues.queries(spark, path).count() == 2
        else:
            with pytest.raises(catalogues.CatalogueError):
                catalogues.queries(spark, path)
    schedule = '[[schedules]]\npricing_id = "{}"\nmodel = "m"\neffective_from = {}\n{}\n'
    window = '[[schedules.windows]]\nname = "{}"\nstart_minute_utc = {}\nend_minute_utc = {}\ninput_cache_hit_usd_per_million = "0.1"\ninput_cache_miss_usd_per_million = "0.2"\noutput_usd_per_million = "0.3"\n'
    day = window.format("d", 0, 1440)
    until = "effective_until = 2026-02-01T00:00:00Z"
    cases = {
        schedule.format("a", "2026-01-01T00:00:00Z", until) + day + schedule.format("b", "2026-02-01T00:00:00Z", "") + window.format("x", 60, 1440) + window.format("y", 0, 60): 3,
        schedule.format("a", "2026-01-01T00:00:00Z", "") + window.format("x", 0, 60) + window.format("y", 61, 1440): 0,
        schedule.format("a", "2026-01-01T00:00:00Z", "") + day + schedule.format("b", "2026-02-01T00:00:00Z", "") + day: 0,
    }
    for text, n in cases.items():
        (tmp_path / "p.toml").write_text(text)
        if n:
            assert catalogues.prices(spark, str(tmp_path / "p.toml")).count() == n
        else:
            with pytest.raises(catalogues.CatalogueError):
                catalogues.prices(spark, str(tmp_path / "p.toml"))


def test_records_of_both_forms(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "x", "n": 1}]')
    (tmp_path / "b.json").write_text('{"sample_notice": "s", "records": [{"id": "y", "n": 2}]}')
    assert sorted(tuple(r) for r in catalogues.records(spark, f"{tmp_path}/*.json", "id string, n long").collect()) == [("x", 1), ("y", 2)]


def _listed(spark, source_id, body, base="https://h.org/list"):
    got = listings.read(spark.createDataFrame([(source_id, base, body)], "source_id string, base_url string, body string"))
    return got.first(), [r.asDict() for r in listings.items(got).orderBy("seq").collect()]


def test_listing_layouts(spark):
    page, got = _listed(spark, "vn_sbv_regulatory_docs", '<a href="/no">x</a><div class="danh-sach-tin-tuc-v32"><li><a class="title-news-link" href="/a?redirect=z&k=1"> Số 38/2026/TT-NHNN về </a><span class="date-about">01/07/2026</span></li><li>no link</li></div><a title="Trang kế tiếp" href="?p=2">n</a>')
    assert (got[0]["url"], got[0]["source_item_id"], got[0]["published_at_raw"]) == ("https://h.org/a?k=1", "38/2026/TT-NHNN", "01/07/2026")
    assert (len(got), page["faulty"], page["next_url"], page["problem"]) == (1, 1, "https://h.org/list?p=2", None)
    assert _listed(spark, "vn_sbv_regulatory_docs", "<p>other</p>")[0]["problem"]
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    _, got = _listed(spark, "vn_moit_regulatory_docs", row("1", "Title", "Số: 12/2026/TT-BCT", "02/07/2026<a href='/d'>x</a>"))
    assert (got[0]["title"], got[0]["source_item_id"], got[0]["raw_metadata"]) == ("Title", "12/2026/TT-BCT", {"document_number": "Số: 12/2026/TT-BCT"})
    _, got = _listed(spark, "vn_mst_regulatory_docs", row("9/QD", "I", "T", "F", "Name <a href='/van-ban-phap-luat/77.htm'>Xem chi tiết</a>", "03/07/2026"))
    assert (got[0]["title"], got[0]["source_item_id"], got[0]["raw_metadata"]["issuer"]) == ("Name", "77", "I")
    block = '{"props":{"x":[{"frns":[{"frnTitle":"T","frnUrl":{"url":"https://www.federalregister.gov/documents/2026/07/01/2026-1/t"},"frnPublicationDate":{"time":"p"}},{"frnTitle":"no url"}]}]}}'
    page, got = _listed(spark, "us_bis_regulatory", f'<script id="__NEXT_DATA__" type="application/json">{block}</script>')
    assert (got[0]["source_item_id"], got[0]["published_at_raw"], page["faulty"]) == ("2026-1", "p", 1)
    _, got = _listed(spark, "us_fhfa_regulatory", row("DateSort ascending", "b", "c", "d", "e") + row("07/13/2026", "T", "N", "Rule", "91 FR 1<a href='https://www.federalregister.gov/documents/2026/07/13/2026-9/x'>f</a><a href='/regulation/federal-register/t'>d</a>"))
    assert (len(got), got[0]["url"], got[0]["source_item_id"]) == (1, "https://h.org/regulation/federal-register/t", "2026-9")
    sure = "Guidelines and Technical standards"
    page, got = _listed(spark, "eu_esma_regulatory", row("13/07/2026", "ESMA75-1-2", "T", sure, "Report", "<a href='/document/t'>x</a>") + row("13/07/2026", "R", "T", "Other", "Report", "<a href='/document/u'>x</a>"))
    assert (len(got), got[0]["source_item_id"], page["faulty"]) == (1, "ESMA75-1-2", 1)
    art = "art_" + "aB" * 16
    _, got = _listed(spark, "cn_samr_market_regulation_bulletins", f'<li><a href="http://www.samr.gov.cn/x/art/{art}.html" title="甲">乙</a><span>[2026-07-01]</span></li><li><a href="/else">z</a></li>')
    assert [(g["title"], g["source_item_id"], g["published_at_raw"], g["url"][:5]) for g in got] == [("甲", art.lower(), "2026-07-01", "https")]
    panel = f'<div class="tabbox-hd"><a>政策文件</a><a>解读</a></div><div class="tabbox-bd"><div><li><a href="https://www.miit.gov.cn/zwgk/zcwj/{art}.html">丙</a><span>2026-07-02</span></li></div><div><li><a href="https://www.miit.gov.cn/zwgk/zcwj/q.html">no</a></li></div></div>'
    _, got = _listed(spark, "cn_miit_policy_listing", panel)
    assert [(g["title"], g["published_at_raw"]) for g in got] == [("丙", "2026-07-02")]


def test_listings_with_details(spark):
    page = lambda s, b, u: (s, u, b)
    pages = spark.createDataFrame([
        page("cn_state_council_policy_docs", '<a href="https://sousuo.www.gov.cn/zhengce/content/1.htm">甲</a><a href="https://sousuo.www.gov.cn/zhengce/content/1.htm">again</a><a href="https://www.gov.cn/zhengce/content/2.htm">乙</a>', "https://sousuo.www.gov.cn/"),
        page("cn_pboc_regulatory_docs", '<div class="Position">部门规章</div><a href="/tiaofasi/144941/144957/20260701/index.html">中国人民银行令〔2026〕第1号</a>', "https://www.pbc.gov.cn/"),
        page("cn_csrc_regulatory_docs", '<title>证监会公告</title><a href="/csrc/c101954/1/content.shtml">一份很长的标题</a>', "https://www.csrc.gov.cn/"),
        page("cn_nea_regulatory_docs", '<div><h3>通知</h3><a href="/2026/c.html">丁</a></div>', "https://www.nea.gov.cn/"),
        page("nobody", "<a>", "https://h/"),
    ], "source_id string, base_url string, body string")
    details = spark.createDataFrame([
        ("https://www.gov.cn/zhengce/content/1.htm", "<p>发文字号：</p><p>国发〔2026〕3号</p><p>成文日期： 2026年7月1日</p>"),
        ("https://www.pbc.gov.cn/tiaofasi/144941/144957/20260701/index.html", '<meta name="PubDate" content="2026-07-01"><div class="Position">部门规章</div>'),
        ("https://www.csrc.gov.cn/csrc/c101954/1/content.shtml", '<meta name="ArticleTitle" content="全名"><p>索引号 bm56000001/2026-01</p><p>发文日期 2026年7月2日</p><p>文号 证监会公告〔2026〕5号</p>'),
        ("https://www.nea.gov.cn/2026/c.html", '<div class="nav">解读</div><p>索引号：000019705/2026-1 制发日期：2026-07-03</p>'),
    ], "url string, body string")
    good, bad = listings.with_details(listings.items(listings.read(pages)), details)
    got = {r["source_id"]: r for r in good.collect()}
    assert {s: (r["source_item_id"], r["published_at_raw"]) for s, r in got.items()} == {"cn_state_council_policy_docs": ("国发〔2026〕3号", "2026-7-1"), "cn_pboc_regulatory_docs": ("中国人民银行令〔2026〕第1号", "2026-07-01"), "cn_csrc_regulatory_docs": ("bm56000001/2026-01", "2026-7-2")}
    assert got["cn_csrc_regulatory_docs"]["title"] == "全名" and got["cn_csrc_regulatory_docs"]["raw_metadata"] == {"document_number": "证监会公告〔2026〕5号"}
    assert {(r["url"], r["reason"]) for r in bad.collect()} == {("https://www.gov.cn/zhengce/content/2.htm", "missing_detail_page"), ("https://www.nea.gov.cn/2026/c.html", "detail_scope_leak")}


def test_discovery_responses(spark):
    bodies = ['{"articles":[{"url":" http://a ","title":" ","language":"English","seendate":"x"},{"title":"no url"},{"url":" "}]}', '{"articles":[]}', "{}", "no json"]
    found, counts = feeds.discovery(spark.createDataFrame([(f"q{k}", "2026-07-01", b) for k, b in enumerate(bodies)], "query_id string, observed_at string, body string"))
    assert [(r["original_url"], r["title"], r["language_hint"], r["published_at_raw"], r["provider_metadata"]) for r in found.collect()] == [("http://a", None, "English", None, {"provider_seendate": "x"})]
    assert [tuple(r)[2:] for r in counts.orderBy("query_id").collect()] == [(3, 2, None), (0, 0, None), (None, None, "no list of articles"), (None, None, "no list of articles")]


def test_corpus(spark):
    pages = lambda *bodies: spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    listed = feeds.corpus_list(pages('{"count":3,"packages":[{"packageId":"PLAW-2"},{"packageId":"PLAW-1"}],"nextPage":"n"}', '{"count":3,"packages":[{"packageId":"PLAW-2"}]}'))
    assert [r["package_id"] for r in listed.orderBy("page", "pos").collect()] == ["PLAW-2", "PLAW-1"]
    for bad in ('{"count":0,"packages":[{"packageId":"PLAW-1"}]}', '{"count":1,"packages":[{"packageId":"../x"}]}', "{}", '{"count":0,"packages":[],"nextPage":"n"}'):
        with pytest.raises(Exception):
            feeds.corpus_list(pages(bad)).collect()
    details = lambda *rows: spark.createDataFrame(list(rows), "package_id string, body string")
    one = ("PLAW-1", '{"packageId":"PLAW-1","collectionCode":"PLAW","title":" T ","lastModified":"m"}')
    two = ("PLAW-2", '{"packageId":"PLAW-2","collectionCode":"PLAW","title":"U","dateIssued":"2026-07-01"}')
    got = feeds.corpus_articles(listed, details(one, two)).orderBy("page", "pos").collect()
    assert [(r["source_item_id"], r["title"], r["published_at_raw"], r["raw_metadata"].get("last_modified")) for r in got] == [("PLAW-2", "U", "2026-07-01", None), ("PLAW-1", "T", None, "m")]
    for wrong in (details(one), details(one, ("PLAW-2", one[1]))):
        with pytest.raises(Exception):
            feeds.corpus_articles(listed, wrong).collect()
