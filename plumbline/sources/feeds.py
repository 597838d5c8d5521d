"""File-backed feeds: RSS and Atom documents, REST pages and SPARQL results as raw articles.

Readers give (articles, payloads): a row an article, and a row a payload with its number of entries, of
unusable ones, and the problem that keeps it from being read (null: none).  An empty feed is no problem;
a payload that isn't what it should be is one, and so is one whose entries are all unusable.  checked()
turns problems into an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.session import shared_folder

_ENTRY = "id:string,guid:string,link:array<struct<_VALUE:string,_href:string,_rel:string>>,title:string,description:string,summary:string,pubDate:string,published:string,updated:string,language:string,_broken:string"
#: A feed's outermost element, and the blocks of its entries; taken one by one, so a broken end doesn't cost the entries before it.
_ROOT = r"(?s)^(?:\s|\ufeff|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>)*<(rss|rdf:RDF|feed)[\s>]"
_BLOCK = r"(?s)(<(?:item|entry)(?:\s[^>]*)?>.*?</(?:item|entry)>)"
SPARQL_URL = "https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:"


def _text(c: Column) -> Column:
    """Blank strings are null."""
    return F.when(F.trim(c) != "", c)


def checked(articles: DataFrame, payloads: DataFrame) -> DataFrame:
    """articles, or an error that names the first problem of a payload."""
    bad = payloads.filter("problem is not null").first()
    if bad is not None:
        raise ValueError(f"{bad['problem']}: {bad.asDict()}")
    return articles


def _told(read: DataFrame, keep: list[str], entries: Column, unusable: Column, wrong: Column) -> DataFrame:
    n, bad = F.coalesce(entries, F.lit(0)), F.coalesce(unusable, F.lit(0))
    problem = wrong.when((n > 0) & (bad == n), "no usable entry")
    return read.select(*keep, F.when(problem.isNull(), n).alias("entries"), F.when(problem.isNull(), bad).alias("unusable"), problem.alias("problem"))


def feed(payloads: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """RSS and Atom documents, a payload each.  An entry without a link is unusable; seq is its place.

    A document that ends too early keeps the entries that are whole; one without entries must be a whole
    feed, or it is no feed.  The link is an Atom entry's alternate one; times and texts fall back as feeds
    differ; language falls back to a payload's column of that name.
    """
    keep = [c for c in payloads.columns if c != body]
    parsed = lambda x: F.from_xml(x, f"struct<{_ENTRY}>", {"columnNameOfCorruptRecord": "_broken"})
    whole = F.from_xml(F.col(body), "struct<_broken:string>", {"columnNameOfCorruptRecord": "_broken"})
    read = payloads.select(*keep, (F.regexp_extract(F.coalesce(F.col(body), F.lit("")), _ROOT, 1) != "").alias("_root"), whole["_broken"].isNull().alias("_whole"), F.regexp_extract_all(F.coalesce(F.col(body), F.lit("")), F.lit(_BLOCK), 1).alias("_blocks"))
    each = read.select(*keep, F.posexplode("_blocks").alias("seq", "_x")).select(*keep, "seq", parsed(F.col("_x")).alias("i"))
    link = F.col("i.link")
    usual = F.filter(link, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    url = F.coalesce(F.get(F.filter(F.transform(usual, lambda x: _text(F.coalesce(x["_href"], x["_VALUE"]))), lambda x: x.isNotNull()), F.lit(0)), F.lit(None).cast("string"))
    hint = F.coalesce("i.language", F.col("language") if "language" in keep else F.lit(None).cast("string"))
    articles = each.select(
        *keep, "seq", F.coalesce("i.id", "i.guid").alias("source_item_id"), url.alias("url"), F.col("i.title").alias("title"), F.coalesce("i.summary", "i.description").alias("description"),
        F.coalesce("i.published", "i.pubDate", "i.updated").alias("published_at_raw"), hint.alias("language_hint"),
    )
    count = articles.groupBy(*keep).agg(F.count_if(F.col("url").isNull()).alias("_bad")) if keep else articles.agg(F.count_if(F.col("url").isNull()).alias("_bad"))
    told = read.alias("r").join(count.alias("n"), _same(keep), "left").select("r.*", "_bad")
    wrong = F.when((F.size("_blocks") == 0) & ~(F.col("_root") & F.col("_whole")), "not a feed")
    return articles.filter("url is not null"), _told(told, keep, F.size("_blocks"), F.col("_bad"), wrong)


def _same(keep: list[str]) -> Column:
    cond = F.lit(True)
    for c in keep:
        cond &= F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}"))
    return cond


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def _string(v: Column, name: str) -> Column:
    """A field of an object if it is a string that isn't blank."""
    field = F.try_variant_get(v, f"$.{name}", "variant")
    return F.when(_kind(field) == "STRING", _text(F.try_variant_get(v, f"$.{name}", "string")))


def rest_pages(payloads: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Pages of a REST source: one row a result with an html_url.  payloads also tell the next page, unless this one is empty."""
    keep = [c for c in payloads.columns if c != body]
    v = F.try_parse_json(F.col(body))
    read = payloads.select(*keep, v.alias("_v")).select("*", F.try_variant_get("_v", "$.results", "array<variant>").alias("_r"), _kind(F.try_variant_get("_v", "$.results", "variant")).alias("_k"))
    rows = read.filter(F.col("_k").startswith("ARRAY")).select(*keep, F.posexplode("_r").alias("seq", "i"))
    rows = rows.select(*keep, "seq", F.trim(_string(F.col("i"), "html_url")).alias("url"), *[_string(F.col("i"), n).alias(c) for c, n in (("source_item_id", "document_number"), ("title", "title"), ("description", "abstract"), ("published_at_raw", "publication_date"))])
    usable = F.size(F.filter("_r", lambda x: _string(x, "html_url").isNotNull()))
    wrong = F.when(F.col("_v").isNull(), "not JSON").when(~_kind(F.col("_v")).startswith("OBJECT"), "not an object").when(~F.col("_k").startswith("ARRAY"), "no list of results")
    told = _told(read, [*keep, "_v"], F.size("_r"), F.size("_r") - usable, wrong)
    told = told.select(*keep, "entries", "unusable", "problem", F.when(F.col("problem").isNull() & (F.col("entries") > 0), _string(F.col("_v"), "next_page_url")).alias("next_url"))
    return rows.filter("url is not null"), told


def next_page_problem(url: Column, endpoint: Column, seen: Column) -> Column:
    """Why a next page may not be fetched, or null: it must be https, of the endpoint's origin and path, without user names, and new."""
    part = lambda c, p: F.try_parse_url(c, F.lit(p))
    origin = lambda c: F.lower(F.concat(part(c, "PROTOCOL"), F.lit("://"), part(c, "AUTHORITY")))
    why = F.when(part(url, "PROTOCOL").isNull() | (F.lower(part(url, "PROTOCOL")) != "https"), "not https").when(part(url, "USERINFO").isNotNull(), "a user name")
    why = why.when(~origin(url).eqNullSafe(origin(endpoint)), "another origin").when(~part(url, "PATH").eqNullSafe(part(endpoint, "PATH")), "another path")
    return F.when(url.isNotNull(), why.when(F.array_contains(seen, url), "a loop"))


#: Stored pages of a source that one row may hold.
WALK_PAGES = 10_000


def _stop(last: Column, there: Column, n: Column, following: Column, left: Column, endpoint: Column, seen: Column) -> Column:
    """Why paging fails at a page, or null."""
    why = F.when(last, "too many pages").when(~there, "a page that isn't there").when((n == 0) & following.isNotNull(), "a next page but no row")
    return why.otherwise(F.when(left > n, next_page_problem(following, endpoint, seen)))


def follow(pages: DataFrame, endpoints: DataFrame, most_pages: int = 10) -> DataFrame:
    """The pages that paging reaches from each endpoint, in order.

    pages: source_id, url, next_url, n_items (what a reader told of each stored page; of pages stored twice
    the least counts).  endpoints: source_id, endpoint, max_items.  Gives source_id, page (from 0), url, n_items
    taken, and problem where paging fails: a next page that may not be fetched, isn't there or brings nothing, or
    too many pages.  Pages meet their source once and are walked within its row; sources of more than WALK_PAGES
    stored pages, if there are any, take a join for each step.
    """
    p = pages.select(F.col("source_id").alias("_s"), F.col("url").alias("_u"), F.col("next_url").alias("_next"), F.col("n_items").cast("long").alias("_n"))
    at = endpoints.select("source_id", "endpoint", F.col("max_items").cast("long").alias("_left"))
    long = p.groupBy("_s").count().filter(F.col("count") > WALK_PAGES).select(F.col("_s").alias("_long"))
    if long.isEmpty():
        return _walk(p, at, most_pages)
    shared_folder(pages.sparkSession)
    long = long.checkpoint()
    part = lambda x, key, how: x.join(long, F.col(key) == F.col("_long"), how)
    walked = _walk(part(p, "_s", "left_anti"), part(at, "source_id", "left_anti"), most_pages)
    return walked.unionByName(_steps(part(p, "_s", "left_semi"), part(at, "source_id", "left_semi"), most_pages))


def _walk(p: DataFrame, at: DataFrame, most_pages: int) -> DataFrame:
    """follow() with all pages of a source in its row."""
    stored = p.groupBy("_s").agg(F.collect_list(F.struct("_u", "_next", "_n")).alias("_stored"))
    rows = at.join(stored.hint("merge"), F.col("source_id") == F.col("_s"), "left")
    told = "array<struct<page:int,url:string,n_items:bigint,problem:string>>"
    once = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731  a value that is used more than once
    state = lambda url, left, seen, out, on: F.struct(url.alias("url"), left.alias("left"), seen.alias("seen"), out.alias("out"), on.alias("on"))

    def step(s, k):
        def page(hit):
            n, following, last = hit["_n"], hit["_next"], k >= most_pages
            taken = F.when(last, F.lit(0).cast("long")).otherwise(F.least(F.coalesce(n, F.lit(0).cast("long")), s["left"]))
            there = hit.isNotNull()
            going = lambda why: F.coalesce(why.isNull() & following.isNotNull() & (s["left"] > n), F.lit(False))
            row = lambda why: F.array(F.struct(k.alias("page"), s["url"].alias("url"), taken.alias("n_items"), why.alias("problem")))
            return once(_stop(last, there, n, following, s["left"], F.col("endpoint"), s["seen"]), lambda why: state(following, s["left"] - n, F.concat(s["seen"], F.array(following)), F.concat(s["out"], row(why)), going(why)))

        return F.when(s["on"], once(F.array_min(F.filter("_stored", lambda x: x["_u"] == s["url"])), page)).otherwise(s)

    begin = state(F.col("endpoint"), F.col("_left"), F.array("endpoint"), F.array().cast(told), F.lit(True))
    return rows.select("source_id", F.inline(F.aggregate(F.sequence(F.lit(0), F.lit(most_pages)), begin, step, lambda s: s["out"])))


def _steps(p: DataFrame, at: DataFrame, most_pages: int) -> DataFrame:
    """follow() with a join for each step; what a step gives is kept, so that no step repeats those before it."""
    p = p.groupBy("_s", "_u").agg(F.min(F.struct("_next", "_n")).alias("_p")).select("_s", "_u", "_p.*")
    at = at.select("source_id", "endpoint", F.col("endpoint").alias("url"), "_left", F.array("endpoint").alias("_seen"))
    found = []
    for k in range(most_pages + 1):
        step = at.join(p.hint("merge"), (F.col("source_id") == F.col("_s")) & (F.col("url") == F.col("_u")), "left")
        taken = F.least(F.coalesce("_n", F.lit(0)), F.col("_left")) if k < most_pages else F.lit(0)
        why = _stop(F.lit(k >= most_pages), F.col("_u").isNotNull(), F.col("_n"), F.col("_next"), F.col("_left"), F.col("endpoint"), F.col("_seen"))
        step = step.select("source_id", "endpoint", "url", "_left", "_seen", "_next", "_n", taken.cast("long").alias("n_items"), why.alias("problem")).checkpoint()
        found.append(step.select("source_id", F.lit(k).alias("page"), "url", "n_items", "problem"))
        on = step.filter("problem is null and _next is not null and _left > _n")
        if k == most_pages or on.isEmpty():
            break
        at = on.select("source_id", "endpoint", F.col("_next").alias("url"), (F.col("_left") - F.col("_n")).alias("_left"), F.concat("_seen", F.array("_next")).alias("_seen"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def sparql(payloads: DataFrame, body: str = "body", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The first titled binding of each act of a payload, in order, `limit` at most; corrigenda are marked.

    A binding that isn't an object, or has no celex, makes the whole payload a problem.
    """
    keep = [c for c in payloads.columns if c != body]
    read = payloads.select(*keep, F.try_parse_json(F.col(body)).alias("_v"))
    read = read.select("*", _kind(F.try_variant_get("_v", "$.results.bindings", "variant")).alias("_k"), F.try_variant_get("_v", "$.results.bindings", "array<variant>").alias("_b"))
    value = lambda x, name: F.trim(F.try_variant_get(x, f"$.{name}.value", "string"))
    broken = F.exists("_b", lambda x: ~_kind(x).startswith("OBJECT") | (_kind(F.try_variant_get(x, "$.celex.value", "variant")) != "STRING"))
    wrong = F.when(F.col("_v").isNull(), "not JSON").when(~_kind(F.col("_v")).startswith("OBJECT"), "not an object").when(~F.col("_k").startswith("ARRAY"), "no list of bindings").when(broken, "a broken binding")
    told = _told(read, keep, F.size("_b"), F.lit(0), wrong)
    rows = read.filter(wrong.isNull()).select(*keep, F.posexplode("_b").alias("seq", "i"))
    named = {"celex": "celex", "work": "cellar_work_uri", "type": "resource_type", "date": "document_date"}
    rows = rows.select(*keep, "seq", value(F.col("i"), "title").alias("title"), *[value(F.col("i"), n).alias(c) for n, c in named.items()])
    rows = rows.filter(F.col("celex").rlike(r"^3\d{4}[RLD]") & (F.col("title") != ""))
    fields = [c for c in rows.columns if c not in (*keep, "celex")]
    first = rows.groupBy(*keep, "celex").agg(F.min_by(F.struct(*fields), "seq").alias("r")).select(*keep, "celex", "r.*")
    remarks = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in ("cellar_work_uri", "resource_type", "document_date")]), lambda e: F.coalesce(e["value"] != "", F.lit(False))))
    out = first.select(*keep, "seq", "celex", F.concat(F.lit(SPARQL_URL), "celex").alias("url"), "title", remarks.alias("raw_metadata"), F.col("celex").rlike(r"R\(\d{2}\)$").alias("is_corrigendum"))
    if limit is not None:
        out = out.withColumn("_k", F.row_number().over(Window.partitionBy(*keep).orderBy("seq"))).filter(F.col("_k") <= limit).drop("_k")
    return out, told


_FOUND = "struct<articles:array<struct<url:string,title:string,language:string,domain:string,sourcecountry:string,seendate:string>>>"
#: Characters of a provider's remark that are kept.
REMARK = 512


def discovery(payloads: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(candidates, counts) of discovery responses (query_id, observed_at, body; other columns are kept in counts).

    A response must be an object with a list of articles, which may be empty; anything else is a
    problem, not an empty answer.  A record without a URL is invalid.  The time a provider saw a
    page is a remark, never its publication.
    """
    keep = [c for c in payloads.columns if c != body]
    p = payloads.withColumn("_a", F.from_json(F.col(body), _FOUND)["articles"])
    good = F.filter("_a", lambda r: F.coalesce(F.trim(r["url"]) != "", F.lit(False)))
    found = F.col("_a").isNotNull()
    counts = p.select(*keep, F.when(found, F.size("_a")).alias("provider_record_count"), F.when(found, F.size("_a") - F.size(good)).alias("invalid_record_count"), F.when(~found, "no list of articles").alias("problem"))
    rows = p.filter(found).select("query_id", "observed_at", F.posexplode(good).alias("seq", "i"))
    remark = lambda name, c: F.struct(F.lit(name).alias("key"), F.substring(F.trim(c), 1, REMARK).alias("value"))
    remarks = F.filter(F.array(remark("sourcecountry", F.col("i.sourcecountry")), remark("provider_seendate", F.col("i.seendate"))), lambda e: F.coalesce(e["value"] != "", F.lit(False)))
    tidy = lambda c: F.trim(_text(F.col(c)))
    none = F.lit(None).cast("string")
    return rows.select("query_id", "observed_at", "seq", F.trim("i.url").alias("original_url"), tidy("i.title").alias("title"), none.alias("published_at_raw"), tidy("i.language").alias("language_hint"), tidy("i.domain").alias("provider_publisher_hint"), F.map_from_entries(remarks).alias("provider_metadata")), counts


_LIST = "struct<count:long,packages:array<struct<packageId:string>>,nextPage:string>"
_SUMMARY = "struct<packageId:string,collectionCode:string,title:string,dateIssued:string,lastModified:string>"
PACKAGE = "^PLAW-[A-Za-z0-9-]+$"


def corpus_list(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages (page: their order, body) of a collection as distinct package ids in order of first sight.

    A page that contradicts itself (no count, more packages than it counts, an unsafe id, an empty
    collection that goes on) fails the scan.
    """
    p = pages.select("page", F.from_json(F.col(body), _LIST).alias("x"))
    n, ids = F.col("x.count"), F.col("x.packages.packageId")
    why = F.when(F.coalesce(n < 0, F.lit(True)) | ids.isNull(), "no count or no packages").when(F.size(ids) > n, "more packages than counted")
    why = why.when((n == 0) & (F.trim("x.nextPage") != ""), "an empty collection goes on").when(F.exists(ids, lambda i: ~F.coalesce(i.rlike(PACKAGE), F.lit(False))), "an unsafe packageId")
    rows = p.select("page", F.posexplode(F.when(why.isNotNull(), F.raise_error(why)).otherwise(ids)).alias("pos", "package_id"))
    return rows.groupBy("package_id").agg(F.min(F.struct("page", "pos")).alias("at")).select("package_id", "at.page", "at.pos")


def corpus_articles(listed: DataFrame, details: DataFrame, code: str = "PLAW", site: str = "https://www.govinfo.gov/app/details/") -> DataFrame:
    """Listed packages with their details (package_id asked for, body); a missing or wrong detail fails the scan."""
    d = details.select(F.col("package_id").alias("_id"), F.from_json("body", _SUMMARY).alias("x"))
    why = F.when(~F.col("x.packageId").eqNullSafe(F.col("package_id")), "a detail of another package").when(~F.col("x.collectionCode").eqNullSafe(F.lit(code)), "another collection").when(_text(F.col("x.title")).isNull(), "no title")
    rows = listed.join(d, F.col("package_id") == F.col("_id"), "left").withColumn("package_id", F.when(why.isNotNull(), F.raise_error(why)).otherwise(F.col("package_id")))
    changed = F.trim(_text(F.col("x.lastModified")))
    meta = F.when(changed.isNull(), F.create_map(F.lit("collection_code"), F.lit(code))).otherwise(F.create_map(F.lit("collection_code"), F.lit(code), F.lit("last_modified"), changed))
    return rows.select("page", "pos", F.col("package_id").alias("source_item_id"), F.concat(F.lit(site), "package_id").alias("url"), F.trim("x.title").alias("title"), _text(F.col("x.dateIssued")).alias("published_at_raw"), meta.alias("raw_metadata"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as payloads: path and body."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))
