"""The registered queries of the operators and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions import dates
from plumbline.functions import text as T
from plumbline.functions import url as U
from plumbline.operators import classify, dedup, discovery, match, normalize, state
from plumbline.session import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _seconds(c: str):
    """A tz-less or UTC timestamp as whole seconds."""
    return F.unix_timestamp(F.col(c).cast("timestamp"))


# Shared SQL pieces ---------------------------------------------------------------------------------
_CANON = r"""SELECT page_id, url,
  lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) ||
  CASE WHEN regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) END ||
  CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical_url
  FROM (SELECT *, array_to_string(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda s: NOT (lower(s) LIKE 'utm\_%' ESCAPE '\' OR lower(string_split(s, '=')[1]) IN ('dclid','fbclid','gclid','mc_cid','mc_eid','msclkid'))), '&') AS q FROM pages)"""


def _canonical(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", U.canonicalize(F.col("url")).alias("canonical_url"))


@_query(_CANON)
def url_canonicalize(spark, sf_dir):
    return _canonical(spark, sf_dir)


@_query(r"""SELECT page_id, array_to_string(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda s: NOT lower(s) LIKE 'utm\_%' ESCAPE '\'), '&') AS query FROM pages""")
def tracking_param_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.without_tracking(F.regexp_extract("url", r"\?([^#]*)", 1)).alias("query"))


_FIRST = f"""WITH c AS ({_CANON}) SELECT page_id, canonical_url, sha256('["v1","canonical_url","pages","' || canonical_url || '"]') AS article_id,
CASE WHEN page_id > min(page_id) OVER (PARTITION BY canonical_url) THEN min(page_id) OVER (PARTITION BY canonical_url) END AS duplicate_of FROM c"""


@_query(_FIRST)
def url_canonical_first_seen(spark, sf_dir):
    """Which pages are one article, and which of them was seen first."""
    pages = _canonical(spark, sf_dir)
    seen = dedup.first_seen(pages, ["canonical_url"], "page_id", "first")
    return seen.select("page_id", "canonical_url", T.json_hash(F.lit("v1"), F.lit("canonical_url"), F.lit("pages"), F.col("canonical_url")).alias("article_id"), F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("duplicate_of"))


_ARTICLES = "SELECT doc_id, source, lang, split_part(text, chr(10), 1) AS title, CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) END AS description FROM documents"


def _articles(spark, sf_dir):
    """Documents as articles: the first line is the title, the rest the description."""
    cut = F.instr("text", "\n")
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.when(cut > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text")).alias("title"), F.when(cut > 0, F.expr("substring(text, instr(text, '\n') + 1)")).alias("description"))


@_query(f"SELECT doc_id, sha256(CAST(to_json(['v1', title, description]) AS VARCHAR)) AS content_hash FROM ({_ARTICLES})")
def article_identity_hash(spark, sf_dir):
    return _articles(spark, sf_dir).select("doc_id", T.json_hash(F.lit("v1"), F.col("title"), F.col("description")).alias("content_hash"))


@_query("SELECT doc_id, CASE WHEN doc_id > m THEN m END AS duplicate_of FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS m FROM documents)")
def content_hash_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return dedup.first_seen(rows, ["content_hash"], "doc_id", "first").select("doc_id", F.when(F.col("doc_id") > F.col("first"), F.col("first")).alias("duplicate_of"))


@_query(f"""WITH r AS (SELECT page_id AS seq, canonical_url, regexp_extract(canonical_url, '^[a-z]+://([^/]+)', 1) AS source_id, nullif(regexp_extract(canonical_url, '/([0-9]+)', 1), '') AS source_item_id, sha256(html) AS content_hash FROM ({_CANON}) JOIN pages USING (page_id, url)),
f AS (SELECT seq, min(seq) OVER (PARTITION BY canonical_url) AS a, CASE WHEN source_item_id IS NOT NULL THEN min(seq) OVER (PARTITION BY source_id, source_item_id) END AS b, min(seq) OVER (PARTITION BY content_hash) AS c FROM r),
g AS (SELECT seq, CASE WHEN a < seq THEN a END AS a, CASE WHEN b < seq THEN b END AS b, CASE WHEN c < seq THEN c END AS c FROM f), h AS (SELECT *, least(a, b, c) AS duplicate_of FROM g)
SELECT seq, duplicate_of, CASE WHEN a = duplicate_of THEN 'CANONICAL_URL' WHEN b = duplicate_of THEN 'SOURCE_ITEM_ID' WHEN c = duplicate_of THEN 'CONTENT_HASH' END AS reason FROM h""")
def dedup_exact_layers(spark, sf_dir):
    c = F.col("canonical_url")
    item = F.regexp_extract(c, "/([0-9]+)", 1)
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), U.canonicalize(F.col("url")).alias("canonical_url"), F.sha2("html", 256).alias("content_hash"))
    rows = rows.select("seq", "canonical_url", U.host_of(c).alias("source_id"), F.when(item != "", item).alias("source_item_id"), "content_hash")
    return dedup.exact_layers(rows).select("seq", "duplicate_of", "reason")


@_query()
def dedup_decision(spark, sf_dir):
    """Documents in order of their ids, with the URL of the page of that id where there is one, and times all over a week whatever the id."""
    seq, c = F.col("doc_id"), F.col("canonical_url")
    item = F.regexp_extract(c, "/([0-9]+)", 1)
    urls = _canonical(spark, sf_dir).withColumnRenamed("page_id", "doc_id")
    rows = _articles(spark, sf_dir).join(urls, "doc_id", "left").select(
        seq.alias("seq"), c, F.coalesce(U.host_of(c), F.col("source")).alias("source_id"), F.when(item != "", item).alias("source_item_id"), T.json_hash(F.lit("v1"), F.col("title"), F.col("description")).alias("content_hash"),
        F.col("lang").alias("market"), T.text_key(F.col("title")).alias("title_key"), (seq * 7_919 % (7 * dedup.DAY)).alias("at"),
    )
    return dedup.all_layers(rows)


@_query("""SELECT event_type AS query_id, props AS key, min_by(event_id, event_id) AS event_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS observed_at FROM
(SELECT *, 1 AS one FROM events) GROUP BY event_type, props""")
def sighting_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("query_id"), F.col("event_id").alias("seq"), "props", _seconds("ts").alias("observed_at"))
    return dedup.sightings(rows, F.col("props")).select("query_id", F.col("props").alias("key"), F.col("seq").alias("event_id"), "observed_at")


# Keyword rules over the invented vocabulary of the test documents.
RULES = classify.Rules(
    [
        classify.Category("LAW_POLICY", ["the and attion"], ["the", "der", "les"], ["with", "und", "dans"]),
        classify.Category("ENERGY", ["energy policy"], ["ing", "ver", "eau"], ["thing", "ach"]),
        classify.Category("TECHNOLOGY", ["of the"], ["that", "mit", "que"], ["this", "von"]),
        classify.Category("FINANCE", ["interest rate"], ["es", "la", "de"], ["reation", "los"]),
    ],
    [classify.Category("VN", [], ["la"], ["los"]), classify.Category("US", [], ["the"], ["and", "of"]), classify.Category("EU", [], ["der", "de"], ["und", "les"]), classify.Category("CN", [], ["ing"], ["thing"])],
    {"AI": ["thing"], "BANKING": ["reation"], "REGULATION": ["the"], "OIL_GAS": ["eau", "von"]},
)


def _has(column: str, words: list[str]) -> str:
    """The SQL for "holds one of these words": borders are consumed, which existence doesn't notice."""
    return "(" + " OR ".join(rf"regexp_matches({column}, '(^|[^\p{{L}}\p{{N}}\p{{M}}_]){w}($|[^\p{{L}}\p{{N}}\p{{M}}_])')" for w in words) + ")" if words else "false"


def _sql_scores() -> str:
    parts = [f"(CASE WHEN {_has('t', c.strong_title)} THEN 4 ELSE 0 END + CASE WHEN {_has('t', c.title)} THEN 2 ELSE 0 END + CASE WHEN {_has('d', c.description)} THEN 1 ELSE 0 END + CASE WHEN only_domain = '{c.name}' THEN 2 ELSE 0 END) AS s_{c.name}" for c in RULES.categories]
    keys = "SELECT doc_id, lower(title) AS t, lower(coalesce(description, '')) AS d, CASE lang WHEN 'en' THEN 'US' WHEN 'de' THEN 'EU' WHEN 'fr' THEN 'EU' ELSE 'VN' END AS m, CASE source WHEN 'src1' THEN 'LAW_POLICY' WHEN 'src2' THEN 'FINANCE' END AS only_domain, source FROM (" + _ARTICLES + ")"
    return f"SELECT *, {', '.join(parts)} FROM ({keys})"


def _keyed(spark, sf_dir):
    rows = _articles(spark, sf_dir)
    market = F.when(F.col("lang") == "en", "US").when(F.col("lang").isin("de", "fr"), "EU").otherwise("VN")
    domain = F.when(F.col("source") == "src1", "LAW_POLICY").when(F.col("source") == "src2", "FINANCE")
    return rows.select("doc_id", "source", T.matching_key(F.col("title")).alias("title_key"), T.matching_key(F.col("description")).alias("description_key"), market.alias("source_market"), domain.alias("only_domain"))


@_query(f"SELECT doc_id, {', '.join(f'CAST(s_{c.name} AS INTEGER) AS {c.name.lower()}' for c in RULES.categories)} FROM ({_sql_scores()})")
def keyword_category_scores(spark, sf_dir):
    return classify.scores(_keyed(spark, sf_dir), RULES).select("doc_id", *[c.name.lower() for c in RULES.categories])


_SORTED = "list_sort([" + ", ".join(f"{{'a': -s_{c.name}, 'b': '{c.name}'}}" for c in RULES.categories) + "])"
_MARKET_SQL = ", ".join(f"CASE WHEN g_{m.name} > 0 AND g_{m.name} + CASE WHEN m = '{m.name}' THEN 1 ELSE 0 END >= 2 THEN '{m.name}' END" for m in RULES.markets)
_CLASSIFIED = f"""WITH s AS (SELECT *, {_SORTED} AS z, {', '.join(f"CASE WHEN {_has('t', m.title)} THEN 2 ELSE 0 END + CASE WHEN {_has('d', m.description)} THEN 1 ELSE 0 END AS g_{m.name}" for m in RULES.markets)} FROM ({_sql_scores()})),
k AS (SELECT *, -z[1].a AS top, -z[2].a AS second, list_filter([{_MARKET_SQL}], lambda x: x IS NOT NULL) AS ms,
  list_filter([{', '.join(f"CASE WHEN {_has('t', w)} OR {_has('d', w)} THEN '{n}' END" for n, w in sorted(RULES.topics.items()))}], lambda x: x IS NOT NULL) AS ts FROM s),
x AS (SELECT *, top >= 4 AND top - second >= 2 AND len(ms) > 0 AS sure FROM k)
SELECT doc_id, source, CASE WHEN sure THEN z[1].b END AS category, CASE WHEN sure THEN array_to_string(ms, ',') ELSE '' END AS markets, CASE WHEN sure THEN array_to_string(ts[1:5], ',') ELSE '' END AS topics,
  CASE WHEN sure THEN least(0.99, round(0.70 + 0.03 * least(top, 8) + 0.02 * least(top - second, 6), 2))::DOUBLE END AS confidence, CASE WHEN sure THEN 'DETERMINISTIC' WHEN source = 'src3' THEN 'MODEL' ELSE 'QUARANTINED' END AS outcome FROM x"""


def _classified(spark, sf_dir):
    return classify.route(classify.classify(_keyed(spark, sf_dir), RULES), F.col("source") == "src3")


@_query(_CLASSIFIED)
def classify_route(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "source", "category", F.array_join("markets", ",").alias("markets"), F.array_join("topics", ",").alias("topics"), F.col("confidence").cast("double").alias("confidence"), "outcome")


@_query("SELECT d.doc_id AS article_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) ORDER BY d.n_chars, d.doc_id LIMIT 100")
def version_anti_join(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("article_id"), F.when(F.col("quality") == 1, "classification-v2").otherwise("classification-v1").alias("classifier_version"))
    articles = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), "source", F.col("n_chars").alias("discovered_at"))
    return normalize.unclassified(articles, done, "classification-v2", 100).select("article_id", "source")


@_query("SELECT doc_id AS article_id, n_chars AS discovered_at, quality FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND (n_chars >= 1000 OR lang = 'en')")
def matching_work_select(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), F.col("source").alias("source_id"), F.col("n_chars").alias("discovered_at"), F.when(F.col("lang") == "en", 1_000).alias("published_at"))
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("article_id"), F.when(F.col("quality") == 1, "SUCCEEDED").otherwise("QUARANTINED").alias("status"), F.lit("classification-v2").alias("classifier_version"), F.lit(10).alias("classified_at"), "quality")
    return normalize.matching_work(docs, done, "classification-v2", 10, 1_000).select("article_id", "discovered_at", "quality")


_PREFS_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS user_id, CASE WHEN c_custkey % 3 = 0 THEN ['US', 'EU'] WHEN c_custkey % 3 = 1 THEN ['VN'] ELSE CAST([] AS VARCHAR[]) END AS markets, CASE WHEN c_nationkey % 2 = 0 THEN ['LAW_POLICY'] ELSE CAST([] AS VARCHAR[]) END AS categories, CASE WHEN c_nationkey % 5 = 0 THEN ['REGULATION', 'AI'] ELSE CAST([] AS VARCHAR[]) END AS topics, 'src' || CAST(c_custkey % 20 AS VARCHAR) AS muted, c_custkey % 2 = 0 AS brk FROM customer"
_MATCHED = f"""WITH c AS ({_CLASSIFIED}), w AS (SELECT CAST(doc_id AS VARCHAR) AS article_id, source, string_split(markets, ',') AS ms, category, CASE WHEN topics = '' THEN [] ELSE string_split(topics, ',') END AS ts, confidence, doc_id * 7919 % 90001 AS disc FROM c WHERE outcome = 'DETERMINISTIC'),
p AS ({_PREFS_SQL}),
x AS (SELECT user_id, article_id, confidence, brk, disc, list_filter(['VN', 'US', 'EU', 'CN'], lambda m: list_contains(ms, m) AND list_contains(markets, m)) AS hm, list_contains(categories, category) AS hc, list_sort(list_intersect(topics, ts)) AS ht, category,
  (len(markets) > 0)::INT + (len(categories) > 0)::INT + (len(topics) > 0)::INT AS active FROM w, p WHERE source <> muted AND 90000 - disc <= 86400),
y AS (SELECT *, (len(hm) > 0)::INT + hc::INT + (len(ht) > 0)::INT AS dims FROM x WHERE len(hm) > 0 OR hc OR len(ht) > 0), z AS (SELECT *, confidence * (dims / active) AS raw FROM y)
SELECT user_id, article_id, array_to_string(list_concat(list_concat(list_transform(hm, lambda m: 'market:' || m), CASE WHEN hc THEN ['category:' || category] ELSE [] END), list_transform(ht, lambda t: 'topic:' || t)), ',') AS reasons,
  CASE WHEN dims >= 2 AND raw >= 0.9 THEN 'HIGH' ELSE 'NORMAL' END AS importance, round(raw, 6) AS score, brk AND dims >= 2 AND raw >= 0.9 AND 90000 - disc BETWEEN 0 AND 7200 AS breaking,
  sha256('["alert-candidate-v1","' || user_id || '","' || article_id || '"]') AS candidate_id FROM z"""


def _work(spark, sf_dir):
    """Classified articles, discovered all over the 25 hours before they are matched."""
    return _classified(spark, sf_dir).filter("outcome = 'DETERMINISTIC'").select(F.col("doc_id").cast("string").alias("article_id"), F.col("source").alias("source_id"), "markets", "category", "topics", F.col("confidence").cast("double").alias("confidence"), F.lit(None).cast("long").alias("published_at"), (F.col("doc_id") * 7_919 % 90_001).alias("discovered_at"), F.lit(90_000).cast("long").alias("matched_at"))


def _preferences(spark, sf_dir):
    """Every customer as a user."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    none = F.expr("cast(array() as array<string>)")
    of = lambda *x: F.array(*map(F.lit, x))
    return table(spark, sf_dir, "customer").select(
        k.cast("string").alias("user_id"), F.when(k % 3 == 0, of("US", "EU")).when(k % 3 == 1, of("VN")).otherwise(none).alias("markets"), F.when(n % 2 == 0, of("LAW_POLICY")).otherwise(none).alias("categories"),
        F.when(n % 5 == 0, of("REGULATION", "AI")).otherwise(none).alias("topics"), F.array(F.concat(F.lit("src"), (k % 20).cast("string"))).alias("muted_source_ids"), none.alias("muted_topics"), (k % 2 == 0).alias("breaking_alert_enabled"),
    )


@_query(_MATCHED)
def alert_match(spark, sf_dir):
    return match.match(_work(spark, sf_dir), _preferences(spark, sf_dir)).withColumn("reasons", F.array_join("reasons", ","))


@_query("SELECT CAST(user_id AS BIGINT) AS user_id, event_type, min(event_id) AS event_id FROM events WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE ts < TIMESTAMP '2024-01-03') GROUP BY ALL")
def candidate_first_write_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    stored = events.filter(F.col("ts") < F.lit("2024-01-03").cast("timestamp")).select("user_id", "event_type").distinct()
    return match.first_write_wins(events, stored, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


_ROUTES = [("/en", "src_en", True), ("/de", "src_de", True), ("/fr", "src_fr", False), ("/en/1", "src_en1", True)]


@_query(f"""WITH c AS ({_CANON}), h AS (SELECT page_id, regexp_extract(canonical_url, '^[a-z]+://([^/]+)', 1) AS host, rtrim(regexp_extract(canonical_url, '^[a-z]+://[^/]+([^?]*)', 1), '/') || '/' AS path FROM c),
r AS (SELECT DISTINCT host, p, s, ok FROM h, (VALUES {', '.join(f"('{p}/', '{s}', {str(ok).lower()})" for p, s, ok in _ROUTES)}) v(p, s, ok) WHERE host LIKE '%.com'),
m AS (SELECT page_id, count(p) AS n, min(s) AS s, bool_and(ok) AS ok FROM h LEFT JOIN r ON h.host = r.host AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, CASE WHEN n = 0 THEN 'UNKNOWN' WHEN n > 1 THEN 'AMBIGUOUS_ROUTE' WHEN NOT ok THEN 'RIGHTS_METADATA_DENIED' WHEN s = 'src_de' THEN 'IDENTITY_INCOMPATIBLE' ELSE 'ADMITTED' END AS admission, CASE WHEN n = 1 THEN s END AS target_source_id FROM m""")
def route_admission(spark, sf_dir):
    c = _canonical(spark, sf_dir).select(F.col("page_id").alias("cand_id"), "canonical_url")
    hosts = c.select(U.host_of(F.col("canonical_url")).alias("hostname")).filter(F.col("hostname").endswith(".com")).distinct()
    mode = lambda s: "NATIVE_SOURCE_ITEM_ID_REQUIRED" if s == "src_de" else "CANONICAL_URL_FALLBACK"
    dim = spark.createDataFrame(_ROUTES, "path_prefix string, target_source_id string, ok boolean")
    each = F.array(*[F.struct(F.lit(p).alias("path_prefix"), F.lit(s).alias("target_source_id"), F.lit(mode(s)).alias("identity_mode")) for p, s, _ in _ROUTES])
    routes = hosts.select("hostname", F.inline(each))
    sources = dim.select(F.col("target_source_id").alias("source_id"), F.col("ok").alias("can_fetch"), F.lit(True).alias("can_store_metadata"))
    return discovery.admit(discovery.resolve(c, routes), sources).select(F.col("cand_id").alias("page_id"), "admission", "target_source_id")


@_query("""WITH e AS (SELECT *, CAST(ts AS DATE) AS dy, CASE WHEN value >= 50 THEN CAST(event_id AS VARCHAR) END AS smp FROM events),
s AS (SELECT dy, event_type, smp, row_number() OVER (PARTITION BY dy, event_type ORDER BY event_id) AS k, event_id FROM e WHERE smp IS NOT NULL)
SELECT CAST(a.dy AS VARCHAR) AS observation_day, a.event_type, a.n AS observation_count, a.f AS first_seen_at, a.l AS last_seen_at, coalesce(b.samples, '') AS samples FROM
(SELECT dy, event_type, count(*) AS n, CAST(epoch_us(min(ts)) AS BIGINT) AS f, CAST(epoch_us(max(ts)) AS BIGINT) AS l FROM e GROUP BY ALL) a LEFT JOIN (SELECT dy, event_type, string_agg(smp, ',' ORDER BY k) AS samples FROM s WHERE k <= 3 GROUP BY ALL) b USING (dy, event_type)""")
def observation_daily_fold(spark, sf_dir):
    folded = _folded(spark, sf_dir)
    return folded.select(F.col("observation_day").cast("string").alias("observation_day"), "event_type", "observation_count", F.unix_micros("first_seen_at").alias("first_seen_at"), F.unix_micros("last_seen_at").alias("last_seen_at"), F.array_join("samples", ",").alias("samples"))


def _folded(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return discovery.fold_daily(events, ["event_type"], "ts", "event_id", F.when(F.col("value") >= 50, F.col("event_id").cast("string")))


@_query("""SELECT CAST(observation_day AS VARCHAR) AS observation_day, event_type, CAST(CASE WHEN observation_day < DATE '2024-01-20' THEN 0 ELSE least(3, n) END AS BIGINT) AS n_samples FROM
(SELECT CAST(ts AS DATE) AS observation_day, event_type, count(*) FILTER (WHERE value >= 50) AS n FROM events GROUP BY ALL) WHERE observation_day >= DATE '2024-01-10'""")
def retention_prune(spark, sf_dir):
    return discovery.prune(_folded(spark, sf_dir), "2024-01-10", "2024-01-20").select(F.col("observation_day").cast("string").alias("observation_day"), "event_type", F.size("samples").cast("long").alias("n_samples"))


_SENTINELS = "SELECT o_orderkey, o_orderpriority, o_orderstatus, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE epoch(o_orderdate)::BIGINT END AS published_at, epoch(l_shipdate)::BIGINT AS seen_at, l_returnflag <> 'N' AS admitted FROM orders JOIN lineitem ON o_orderkey = l_orderkey"


def _sentinels(spark, sf_dir):
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    return items.join(orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderpriority", "o_orderstatus", "l_linenumber", F.when(F.col("l_linenumber") != 7, _seconds("o_orderdate")).alias("published_at"), _seconds("l_shipdate").alias("seen_at"), (F.col("l_returnflag") != "N").alias("admitted"))


@_query(f"""SELECT o_orderkey, CAST(min_by(published_at, l_linenumber) FILTER (WHERE published_at IS NOT NULL) AS BIGINT) AS published_at, min(seen_at) AS direct_at, min(seen_at) FILTER (WHERE admitted) AS seen_at FROM ({_SENTINELS}) GROUP BY o_orderkey""")
def evidence_fold(spark, sf_dir):
    rows = _sentinels(spark, sf_dir).select("o_orderkey", "l_linenumber", "published_at", F.col("seen_at").alias("direct_at"), F.when(F.col("admitted"), F.col("seen_at")).alias("seen_at"))
    return discovery.fold_evidence(rows, ["o_orderkey"], "l_linenumber")


_YEAR = 365 * 86_400
_RATES = f"""SELECT o_orderpriority, count(published_at) AS n, coalesce(avg(CASE WHEN published_at IS NOT NULL THEN CASE WHEN admitted AND seen_at - published_at <= {_YEAR} THEN 1.0 ELSE 0.0 END END), 0) AS rate_fast,
coalesce(avg(CASE WHEN published_at IS NOT NULL THEN CASE WHEN admitted AND seen_at - published_at <= {3 * _YEAR} THEN 1.0 ELSE 0.0 END END), 0) AS rate_slow,
count(*) FILTER (WHERE published_at IS NOT NULL AND NOT coalesce(admitted AND seen_at - published_at <= {3 * _YEAR}, false)) AS missed,
CAST(quantile_disc(d, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc(d, 0.95) AS DOUBLE) AS p95 FROM (SELECT *, CASE WHEN admitted AND published_at IS NOT NULL THEN seen_at - published_at END AS d FROM ({_SENTINELS})) GROUP BY 1"""


@_query(f"SELECT o_orderpriority, n, round(rate_fast, 9) AS rate_fast, round(rate_slow, 9) AS rate_slow, missed, p50, p95 FROM ({_RATES})")
def capture_rates(spark, sf_dir):
    c = discovery.capture(_sentinels(spark, sf_dir), ["o_orderpriority"], {"fast": _YEAR, "slow": 3 * _YEAR})
    return c.withColumns({k: F.round(k, 9) for k in ("rate_fast", "rate_slow")})


@_query(f"""SELECT o_orderpriority, CASE WHEN days < 14 OR n < 50 THEN 'INSUFFICIENT_DATA' WHEN f >= 0.90 AND s >= 0.97 THEN 'GREEN_A' WHEN f >= 0.85 AND s >= 0.95 THEN 'GREEN_B' WHEN f >= 0.75 AND s >= 0.90 THEN 'YELLOW' ELSE 'RED' END AS tier
FROM (SELECT o_orderpriority, n, days, least(1.0, rate_fast * 2) AS f, least(1.0, rate_slow * 2) AS s FROM ({_RATES}) JOIN (SELECT o_orderpriority, count(DISTINCT epoch(o_orderdate)) FILTER (WHERE o_orderpriority <> '5-LOW' OR month(o_orderdate) = 1 AND day(o_orderdate) = 1) AS days FROM orders GROUP BY 1) USING (o_orderpriority))""")
def benchmark_tier(spark, sf_dir):
    c = discovery.capture(_sentinels(spark, sf_dir), ["o_orderpriority"], {"fast": _YEAR, "slow": 3 * _YEAR})
    up = lambda k: F.least(F.lit(1.0), F.col(k) * 2)
    day = F.col("o_orderdate")
    watched = (F.col("o_orderpriority") != "5-LOW") | ((F.month(day) == 1) & (F.dayofmonth(day) == 1))  # one priority is watched for too few days
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("_p")).agg(F.count_distinct(F.when(watched, day)).alias("days"))
    c = c.join(days, F.col("o_orderpriority") == F.col("_p"))
    return c.select("o_orderpriority", discovery.tier(F.col("days"), F.col("n"), up("rate_fast"), up("rate_slow")).alias("tier"))


@_query(f"SELECT host, count(*) AS n, (count(*) - count(DISTINCT canonical_url)) / count(*) AS rate FROM (SELECT *, regexp_extract(canonical_url, '^[a-z]+://([^/]+)', 1) AS host FROM ({_CANON})) GROUP BY host")
def duplicate_candidate_rate(spark, sf_dir):
    c = _canonical(spark, sf_dir).withColumn("host", U.host_of(F.col("canonical_url")))
    return discovery.duplicate_rate(c, ["host"], "url")


# Price windows of two models: one has a flat schedule and then one with a peak, the other one schedule.  Rates are per million tokens.
_PRICES = [("flat", "chat", "all", 0, 1_705_276_800, 0, 1440, 2, 14, 28), ("peak", "chat", "night", 1_705_276_800, None, 0, 480, 7, 22, 66), ("peak", "chat", "day", 1_705_276_800, None, 480, 1440, 14, 44, 132), ("mini", "mini", "all", 0, None, 0, 1440, 1, 3, 5)]


@_query(f"""WITH p(pricing_id, model, w, f, u, a, b, h, m, o) AS (VALUES {', '.join('(' + ', '.join('NULL' if x is None else repr(x) for x in r) + ')' for r in _PRICES)})
SELECT event_id AS usage_id, pricing_id, w AS "window", CAST((user_id * h + CAST(floor(value) AS BIGINT) * m + 100 * o) AS DOUBLE) / 1e6 AS cost FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CASE WHEN user_id % 3 = 0 THEN 'mini' ELSE 'chat' END AS used FROM events)
JOIN p ON model = used AND sec >= f AND sec < coalesce(u, 99999999999) AND (sec // 60) % 1440 >= a AND (sec // 60) % 1440 < b""")
def pricing_asof_cost(spark, sf_dir):
    schedule = spark.createDataFrame(_PRICES, "pricing_id string, model string, window string, effective_from long, effective_until long, start_minute int, end_minute int, hit_rate int, miss_rate int, output_rate int")
    user = F.col("user_id").cast("long")
    usage = table(spark, sf_dir, "events").select(F.col("event_id").alias("usage_id"), F.when(user % 3 == 0, "mini").otherwise("chat").alias("model"), _seconds("ts").alias("at"), user.alias("hit"), F.floor("value").cast("long").alias("miss"), F.lit(100).cast("long").alias("output"))
    return state.price(usage, schedule).withColumn("cost", F.col("cost").cast("double"))


_NOW = 900_000_000
_STATE_SQL = "SELECT o_orderkey AS article_id, CASE o_orderstatus WHEN 'F' THEN 'RETRYABLE' WHEN 'O' THEN 'PROCESSING' ELSE 'SUCCEEDED' END AS status, epoch(o_orderdate)::BIGINT AS sec, o_orderkey % 4 AS attempt_count, o_custkey FROM orders"


def _state(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "RETRYABLE").when(F.col("o_orderstatus") == "O", "PROCESSING").otherwise("SUCCEEDED")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("article_id"), status.alias("status"), _seconds("o_orderdate").alias("at"), (F.col("o_orderkey") % 4).alias("attempt_count"), F.col("o_custkey"))


@_query(f"""SELECT article_id, CASE WHEN status = 'PROCESSING' AND attempt_count >= 3 THEN 'QUARANTINED' ELSE 'PROCESSING' END AS status, CAST(attempt_count + CASE WHEN status = 'PROCESSING' AND attempt_count >= 3 THEN 0 ELSE 1 END AS BIGINT) AS attempt_count,
CASE WHEN NOT (status = 'PROCESSING' AND attempt_count >= 3) THEN {_NOW} + 300 END AS lease_expires_at, CASE WHEN status = 'PROCESSING' AND attempt_count >= 3 THEN 'RECOVERED_QUARANTINED' ELSE 'CLAIMED' END AS outcome,
CASE WHEN NOT (status = 'PROCESSING' AND attempt_count >= 3) THEN sha256('run-1:' || article_id || ':' || (attempt_count + 1)) END AS claim_token, CASE WHEN status = 'PROCESSING' AND attempt_count >= 3 THEN 'lease_expired_attempt_budget_exhausted' END AS error FROM ({_STATE_SQL}) WHERE status IN ('RETRYABLE', 'PROCESSING') AND sec <= {_NOW} ORDER BY sec, article_id LIMIT 100""")
def queue_claim_topk(spark, sf_dir):
    s = _state(spark, sf_dir).select("article_id", "status", F.col("at").alias("next_attempt_at"), F.col("at").alias("lease_expires_at"), F.col("at").alias("created_at"), "attempt_count", F.lit(3).alias("max_attempts"))
    return state.claim(s, _NOW, 100, 300, "run-1")


@_query("SELECT c_custkey, c_name FROM customer WHERE c_custkey > 40 ORDER BY c_custkey LIMIT 100")
def keyset_page(spark, sf_dir):
    return normalize.page(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 40, 100)


@_query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 50 AS chosen, min(doc_id) OVER (PARTITION BY text) AS first FROM documents), g AS (SELECT *, chosen AND n_chars >= 100 AS good FROM s)
SELECT source AS source_id, count(*) AS fetched, count(*) FILTER (WHERE chosen) AS selected, count(*) FILTER (WHERE good) AS normalized, count(*) FILTER (WHERE chosen AND NOT good) AS rejected, count(*) FILTER (WHERE good AND doc_id > first) AS duplicate,
count(*) FILTER (WHERE good AND source NOT LIKE '%1') AS persisted, count(*) FILTER (WHERE good AND source LIKE '%1') AS storage_skipped FROM g GROUP BY source""")
def source_counters(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("source").alias("source_id"), "n_chars", F.sha2("text", 256).alias("content_hash"))
    seen = dedup.first_seen(rows, ["content_hash"], "seq", "first")
    chosen = normalize.first_of_each(seen, 50)
    articles = chosen.filter("n_chars >= 100")
    storing = rows.select("source_id").distinct().filter(~F.col("source_id").endswith("1"))
    return normalize.counters(rows, chosen, articles, chosen.filter("n_chars < 100"), articles.filter("seq > first"), storing)


@_query("SELECT 'orders' AS target, count(*) AS dangling FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)")
def referential_closure(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    out = []
    for name, key, target in (("orders", "l_orderkey", "o_orderkey"), ("part", "l_partkey", "p_partkey")):
        keys = table(spark, sf_dir, name).select(F.col(target).alias("k"))
        out.append(items.select(key).join(keys, F.col(key) == F.col("k"), "left_anti").agg(F.lit(name).alias("target"), F.count("*").alias("dangling")))
    return out[0].unionByName(out[1])


@_query("SELECT conv_id, count(*) AS turns, bool_and(turn = k) AS in_order FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations) GROUP BY conv_id")
def conversation_order_check(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return c.withColumn("k", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).groupBy("conv_id").agg(F.count("*").alias("turns"), F.bool_and(F.col("turn") == F.col("k")).alias("in_order"))


@_query("""SELECT o_orderkey, l_linenumber, discovered - published AS discovery_latency, classified - discovered AS classification_latency, matched - classified AS matching_latency, queued - matched AS queue_latency, sent - queued AS delivery_latency, sent - published AS end_to_end_latency FROM
(SELECT o_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN epoch(o_orderdate)::BIGINT END AS published, epoch(l_shipdate)::BIGINT AS discovered, epoch(l_shipdate)::BIGINT + l_linenumber * 60 AS classified, epoch(l_shipdate)::BIGINT + l_linenumber * 90 AS matched,
CASE WHEN l_returnflag <> 'N' THEN epoch(l_shipdate)::BIGINT + 600 END AS queued, CASE WHEN l_returnflag <> 'N' THEN epoch(l_shipdate)::BIGINT + 605 END AS sent FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""")
def latency_chain(spark, sf_dir):
    s, n = _sentinels(spark, sf_dir), F.col("l_linenumber")
    seen = F.col("seen_at")
    rows = s.select("o_orderkey", n, "published_at", seen.alias("discovered_at"), (seen + n * 60).alias("classified_at"), (seen + n * 90).alias("matched_at"), F.when(F.col("admitted"), seen + 600).alias("queued_at"), F.when(F.col("admitted"), seen + 605).alias("sent_at"))
    return discovery.latencies(rows, ["o_orderkey", "l_linenumber"])


@_query("SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 10")
def bounded_selection(spark, sf_dir):
    return normalize.first_of_each(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), 10, "source", "doc_id")


@_query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def status_pivot_count(spark, sf_dir):
    return discovery.pivot_counts(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", {s.lower(): s for s in "FOP"})


# Dates as providers write them: five forms made from the orders' dates.
_WRITTEN = """SELECT o_orderkey, o_orderdate, CASE o_orderkey % 6 WHEN 0 THEN 'us_fhfa_regulatory' WHEN 1 THEN 'eu_esma_regulatory' WHEN 2 THEN 'cn_miit_policy_listing' ELSE 'vn_sbv_regulatory_docs' END AS source_id FROM orders"""


@_query(f"""SELECT o_orderkey, source_id, CAST(epoch(CASE o_orderkey % 6 WHEN 0 THEN o_orderdate AT TIME ZONE 'America/New_York' WHEN 1 THEN o_orderdate AT TIME ZONE 'Europe/Paris' WHEN 2 THEN o_orderdate AT TIME ZONE 'Asia/Shanghai'
WHEN 3 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 7 HOUR WHEN 4 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE END) AS BIGINT) AS published_at FROM ({_WRITTEN}) WHERE o_orderkey % 6 > 2
UNION ALL SELECT o_orderkey, source_id, CAST(epoch(timezone(CASE o_orderkey % 6 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Europe/Paris' ELSE 'Asia/Shanghai' END, CAST(o_orderdate AS TIMESTAMP))) AS BIGINT) FROM ({_WRITTEN}) WHERE o_orderkey % 6 <= 2""")
def published_at_parse(spark, sf_dir):
    kind, day = F.col("o_orderkey") % 6, F.col("o_orderdate").cast("timestamp")
    source = F.when(kind == 0, "us_fhfa_regulatory").when(kind == 1, "eu_esma_regulatory").when(kind == 2, "cn_miit_policy_listing").otherwise("vn_sbv_regulatory_docs")
    forms = [(0, "M/d/yyyy"), (1, "dd/MM/yyyy"), (2, "yyyy-MM-dd"), (3, "d/M/yyyy | HH:mm:ss"), (4, "yyyy-MM-dd'T'HH:mm:ss'-01:30'")]
    raw = F.coalesce(*[F.when(kind == k, F.date_format(day, f)) for k, f in forms], F.date_format(day, "yyyy-MM-dd"))  # the last: no offset, so no time
    rows = table(spark, sf_dir, "orders").select("o_orderkey", source.alias("source_id"), raw.alias("raw"))
    return rows.select("o_orderkey", "source_id", F.unix_timestamp(dates.published_at(F.col("raw"), F.col("source_id"))).alias("published_at"))


_DISPOSITIONS = "(VALUES ('GREEN_A', 'PRIMARY', 'MAY_REDUCE_TO_SENTINEL', 'DISCOVERY_ACCELERATOR', 'REQUIRED'), ('GREEN_B', 'PRIMARY', 'MAY_REDUCE_TO_SENTINEL', 'DISCOVERY_ACCELERATOR', 'REQUIRED'), ('YELLOW', 'PARALLEL_DISCOVERY', 'REQUIRED', 'PARALLEL_DISCOVERY', 'REQUIRED'), ('RED', 'SUPPLEMENTAL', 'REQUIRED_PRIMARY', 'SUPPLEMENTAL', 'REQUIRED_PRIMARY'), ('INSUFFICIENT_DATA', 'NO_CHANGE', 'UNCHANGED', 'NO_CHANGE', 'UNCHANGED')) v(tier, r1, p1, r2, p2)"


@_query(f"SELECT c_custkey, tier, CASE WHEN c_custkey % 2 = 0 THEN r1 ELSE r2 END AS role, CASE WHEN c_custkey % 2 = 0 THEN p1 ELSE p2 END AS direct_path FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'GREEN_A' WHEN 1 THEN 'GREEN_B' WHEN 2 THEN 'YELLOW' WHEN 3 THEN 'RED' ELSE 'INSUFFICIENT_DATA' END AS tier FROM customer) JOIN {_DISPOSITIONS} USING (tier)")
def direct_path_disposition(spark, sf_dir):
    k = F.col("c_custkey")
    tier = F.element_at(F.array(*map(F.lit, ("GREEN_A", "GREEN_B", "YELLOW", "RED", "INSUFFICIENT_DATA"))), (k % 5 + 1).cast("int"))
    mode = F.when(k % 2 == 0, "CANONICAL_URL_FALLBACK").otherwise("NATIVE_SOURCE_ITEM_ID_REQUIRED")
    return table(spark, sf_dir, "customer").select(k, tier.alias("tier"), mode.alias("mode")).withColumn("p", discovery.policy(F.col("tier"), F.col("mode"))).select("c_custkey", "tier", "p.role", "p.direct_path")


_CATEGORIES = ("RIGHTS_DENIED", "EMPTY_CONTENT", "CONFIGURATION", "RATE_LIMIT", "TIMEOUT", "UNLISTED")


@_query(f"""SELECT o_orderkey, category, CASE WHEN category = 'RIGHTS_DENIED' OR category = 'UNLISTED' AND NOT retryable THEN 'QUARANTINE' WHEN category = 'RATE_LIMIT' OR category IN ('CONFIGURATION', 'TIMEOUT') AND NOT retryable THEN 'RETRY_60_MINUTES'
WHEN attempt_count <= 1 THEN 'RETRY_15_MINUTES' ELSE 'RETRY_60_MINUTES' END AS disposition, category IN ('EMPTY_CONTENT', 'CONFIGURATION', 'RATE_LIMIT', 'TIMEOUT') OR retryable AS retryable,
CASE WHEN category = 'CONFIGURATION' THEN 'CONFIGURATION' WHEN category IN ('RATE_LIMIT', 'TIMEOUT') OR category = 'UNLISTED' AND retryable THEN 'SYSTEMIC_PROVIDER' END AS stop_reason
FROM (SELECT o_orderkey, ([{", ".join(f"'{c}'" for c in _CATEGORIES)}])[CAST(o_custkey % 6 + 1 AS INT)] AS category, o_orderkey % 3 = 0 AS retryable, o_orderkey % 4 AS attempt_count FROM orders)""")
def failure_disposition(spark, sf_dir):
    category = F.element_at(F.array(*map(F.lit, _CATEGORIES)), (F.col("o_custkey") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", category.alias("category"), (F.col("o_orderkey") % 3 == 0).alias("r"), (F.col("o_orderkey") % 4).alias("n"))
    return rows.withColumn("d", state.disposition(F.col("category"), F.col("r"), F.col("n"))).select("o_orderkey", "category", "d.disposition", "d.retryable", "d.stop_reason")


def _stored(spark, sf_dir):
    """Half of the orders as stored rows of a queue."""
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "RETRYABLE").when(F.col("o_orderstatus") == "O", "PROCESSING").otherwise("SUCCEEDED")
    usage = [F.lit(n).cast("decimal(24,12)" if c == "estimated_cost_usd" else "long").alias(c) for c, n in zip(state.USAGE, (10, 4, 6, 5, 15, 1))]
    return table(spark, sf_dir, "orders").filter(k % 2 == 0).select(k.alias("article_id"), F.lit("classification-v2").alias("classifier_version"), F.lit("m").alias("requested_model"), F.when(k % 6 == 0, "p1").otherwise("p2").alias("prompt_version"), F.lit("t").alias("taxonomy_version"), status.alias("status"), F.when(status == "PROCESSING", F.concat(F.lit("t"), k)).alias("claim_token"), F.when(status == "PROCESSING", _seconds("o_orderdate")).alias("lease_expires_at"), (k % 4).alias("attempt_count"), F.lit(2).alias("max_attempts"), *usage)


@_query("SELECT o_orderkey AS article_id, CASE WHEN o_orderkey % 2 = 1 THEN 'CREATED' WHEN o_orderkey % 6 = 0 THEN 'LINEAGE_MISMATCH' WHEN o_orderstatus = 'F' THEN 'EXISTING_RETRYABLE' WHEN o_orderstatus = 'O' THEN 'EXISTING_PROCESSING' ELSE 'ALREADY_SUCCEEDED' END AS outcome, CASE WHEN o_orderkey % 6 = 0 THEN 'prompt_version' ELSE '' END AS mismatched_fields FROM orders")
def queue_enqueue(spark, sf_dir):
    commands = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("article_id"), *[F.lit(v).alias(c) for c, v in (("classifier_version", "classification-v2"), ("requested_model", "m"), ("prompt_version", "p2"), ("taxonomy_version", "t"))])
    return state.enqueue(commands, _stored(spark, sf_dir)).select("article_id", "outcome", F.array_join("mismatched_fields", ",").alias("mismatched_fields"))


def _tokens(orders):
    """A command for each order, one in five with another token."""
    k = F.col("o_orderkey")
    return orders.select(k.alias("article_id"), F.lit("classification-v2").alias("classifier_version"), F.when(k % 5 == 0, "other").otherwise(F.concat(F.lit("t"), k)).alias("claim_token"))


@_query(f"SELECT o_orderkey AS article_id, CASE WHEN ok THEN 'RENEWED' ELSE 'LOST_CLAIM' END AS outcome, CASE WHEN ok THEN {_NOW} + 300 END AS lease_expires_at FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AND o_orderstatus = 'O' AND o_orderkey % 5 <> 0 AND epoch(o_orderdate) > {_NOW} AS ok FROM orders)")
def queue_renew(spark, sf_dir):
    """A command for every order, of which half is stored; others have lost their claim."""
    return state.renew(_tokens(table(spark, sf_dir, "orders")), _stored(spark, sf_dir), _NOW, 300).select("article_id", "outcome", "lease_expires_at")


@_query(f"SELECT o_orderkey AS article_id, CASE WHEN ok THEN 'SUCCEEDED' WHEN stored AND o_orderstatus = 'P' THEN 'ALREADY_SUCCEEDED' ELSE 'LOST_CLAIM' END AS outcome, CAST(CASE WHEN ok THEN 35 WHEN stored THEN 15 END AS BIGINT) AS total_tokens FROM (SELECT *, stored AND o_orderstatus = 'O' AND o_orderkey % 5 <> 0 AND epoch(o_orderdate) > {_NOW} AS ok FROM (SELECT *, o_orderkey % 2 = 0 AS stored FROM orders))")
def queue_complete(spark, sf_dir):
    usage = [F.lit(n).cast("decimal(24,12)" if c == "estimated_cost_usd" else "long").alias(c) for c, n in zip(state.USAGE, (12, 6, 6, 8, 20, 2))]
    commands = _tokens(table(spark, sf_dir, "orders")).select("*", F.lit("PROVIDER").alias("method"), F.lit(1).alias("provider_attempts"), *usage)
    return state.complete(commands, _stored(spark, sf_dir), _NOW).select("article_id", "outcome", "total_tokens")


@_query(f"""SELECT o_orderkey AS article_id, CASE WHEN NOT ok THEN 'LOST_CLAIM' WHEN refused OR o_orderkey % 4 >= 2 THEN 'QUARANTINED' ELSE 'RETRY_SCHEDULED' END AS outcome, CASE WHEN ok THEN CASE WHEN NOT refused AND o_orderkey % 4 >= 2 THEN 'attempt_budget_exhausted' ELSE 'INVALID_OUTPUT' END END AS error,
CASE WHEN ok AND NOT refused AND o_orderkey % 4 < 2 THEN {_NOW} + CASE WHEN o_custkey % 2 = 0 THEN 3600 ELSE 900 END END AS next_attempt_at, CAST(CASE WHEN ok THEN 35 WHEN stored THEN 15 END AS BIGINT) AS total_tokens FROM
(SELECT *, stored AND o_orderstatus = 'O' AND o_orderkey % 5 <> 0 AND epoch(o_orderdate) > {_NOW} AS ok, o_custkey % 7 = 0 OR o_custkey % 11 = 0 AS refused FROM (SELECT *, o_orderkey % 2 = 0 AS stored FROM orders))""")
def queue_fail_transition(spark, sf_dir):
    orders, c = table(spark, sf_dir, "orders"), F.col("o_custkey")
    usage = [F.lit(n).cast("decimal(24,12)" if name == "estimated_cost_usd" else "long").alias(name) for name, n in zip(state.USAGE, (12, 6, 6, 8, 20, 2))]
    told = orders.select(F.col("o_orderkey").alias("article_id"), F.lit("INVALID_OUTPUT").alias("category"), F.lit(502).alias("http_status"), (c % 7 != 0).alias("retryable"), F.when(c % 11 == 0, "QUARANTINE").when(c % 2 == 0, "RETRY_60_MINUTES").otherwise("RETRY_15_MINUTES").alias("disposition"), F.lit(1).alias("provider_attempts"), *usage)
    return state.fail(_tokens(orders).join(told, "article_id"), _stored(spark, sf_dir), _NOW).select("article_id", "outcome", "error", "next_attempt_at", "total_tokens")


@_query(f"SELECT host, avg(CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END) AS unknown_rate FROM (SELECT page_id, host, count(p) AS n FROM (SELECT page_id, regexp_extract(canonical_url, '^[a-z]+://([^/]+)', 1) AS host, rtrim(regexp_extract(canonical_url, '^[a-z]+://[^/]+([^?]*)', 1), '/') || '/' AS path FROM ({_CANON})) LEFT JOIN (VALUES ('/en/'), ('/fr/')) v(p) ON starts_with(path, p) GROUP BY ALL) GROUP BY host")
def unknown_publisher_rate(spark, sf_dir):
    c = _canonical(spark, sf_dir).select(F.col("page_id").alias("cand_id"), "canonical_url")
    each = F.array(*[F.struct(F.lit(p).alias("path_prefix"), F.lit(p[1:]).alias("target_source_id"), F.lit("CANONICAL_URL_FALLBACK").alias("identity_mode")) for p in ("/en", "/fr")])
    routes = c.select(U.host_of(F.col("canonical_url")).alias("hostname")).distinct().select("hostname", F.inline(each))
    sources = spark.createDataFrame([("en", True, True), ("fr", True, True)], "source_id string, can_fetch boolean, can_store_metadata boolean")
    return discovery.unknown_rate(discovery.admit(discovery.resolve(c, routes), sources).withColumn("host", U.host_of(F.col("canonical_url"))), ["host"])


@_query("SELECT c_custkey AS source_id, CAST(c_nationkey AS INT) AS priority FROM customer WHERE c_custkey IN (3, 7, 11, 19) ORDER BY c_nationkey DESC, c_custkey")
def source_selection(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.col("c_nationkey").cast("int").alias("priority"))
    return normalize.select_sources(rows, [3, 7, 11, 19])


def _others() -> None:
    """Registers the queries of the other modules."""
    from plumbline.plans import rows, scans  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _others()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _others()
    return dict(_SQL)
