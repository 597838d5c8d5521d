"""Queries of row operators: normalisation, rights, selection, checks, counters, transitions, keys and sinks."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import functions as F

from plumbline.functions import dates
from plumbline.functions import text as T
from plumbline.functions import url as U
from plumbline.operators import checks, classify, counters, discovery, match, model, normalize, state
from plumbline.plans.catalogue import _CANON, _CLASSIFIED, RULES, _canonical, _has, _keyed, _preferences, _query, _seconds, _sql_scores, _work
from plumbline.session import shared_folder, table
from plumbline.streaming import sinks


def _text(c):
    return F.col(c).cast("string")


# Normalisation and selection ---------------------------------------------------------------------
def _raw(spark, sf_dir):
    """Every document as a raw article; some without a title, some with a wrong address, some of an unknown source."""
    k, n = F.col("doc_id"), F.col("n_chars")
    docs = table(spark, sf_dir, "documents")
    title = F.when(n % 7 == 0, F.lit(" <script>x</script> ")).otherwise(F.concat(F.lit("<b>"), "source", F.lit("</b>&amp;"), "lang", F.lit("<hr>x<tbody>y")))
    url = F.when(n % 11 == 0, F.lit("ftp://h/x")).otherwise(F.concat(F.lit("HTTPS://H"), _text("doc_id"), F.lit(".Example:443/A?utm_x=1&b=2#c")))
    raw = docs.select(k.alias("seq"), F.when(k % 13 == 0, "nobody").otherwise(F.col("source")).alias("source_id"), F.when(k % 2 == 0, F.concat(F.lit(" i  "), _text("doc_id"), F.lit("\t"))).alias("source_item_id"), url.alias("url"), title.alias("title"),
                      F.when(k % 3 == 0, F.concat(F.lit("<p>d"), _text("n_chars"), F.lit("</p>"))).alias("description"), F.lit("2026-07-13T10:00:00Z").alias("published_at_raw"), F.when(k % 5 == 0, F.lit(" vi ")).alias("language_hint"), F.lit(0).alias("retrieved_at"))
    sources = docs.select(F.col("source").alias("source_id")).distinct().select("source_id", F.lit("US").alias("market"), F.lit("en").alias("language"))
    return normalize.normalize(raw, sources)


_RAW = "SELECT doc_id AS seq, CASE WHEN doc_id % 13 = 0 THEN 'nobody' ELSE source END AS source_id, CASE WHEN doc_id % 13 = 0 THEN 'source_id' WHEN n_chars % 11 = 0 THEN 'url' WHEN n_chars % 7 = 0 THEN 'title' END AS bad, 'https://h' || doc_id || '.example/A?b=2' AS canonical_url, source || '&' || lang || 'x y' AS title, CASE WHEN doc_id % 3 = 0 THEN 'd' || n_chars END AS description, CASE WHEN doc_id % 2 = 0 THEN 'i  ' || doc_id END AS item, doc_id % 5 = 0 AS vi FROM documents"


@_query(f"""SELECT seq, CASE WHEN item IS NOT NULL THEN sha256(CAST(to_json(['v1', 'source_item_id', source_id, item]) AS VARCHAR)) ELSE sha256(CAST(to_json(['v1', 'canonical_url', source_id, canonical_url]) AS VARCHAR)) END AS article_id, item AS source_item_id, canonical_url, title, description,
CASE WHEN vi THEN 'vi' ELSE 'en' END AS language, sha256(CAST(to_json(['v1', title, description]) AS VARCHAR)) AS content_hash, 1783936800 AS published_at FROM ({_RAW}) WHERE bad IS NULL""")
def normalize_article(spark, sf_dir):
    return _raw(spark, sf_dir)[0].select("seq", "article_id", "source_item_id", "canonical_url", "title", "description", "language", "content_hash", F.unix_timestamp("published_at").alias("published_at"))


@_query(f"SELECT seq, source_id, bad AS field, CASE bad WHEN 'source_id' THEN 'unknown source' WHEN 'url' THEN 'not an absolute http(s) URL' ELSE 'missing or empty' END AS reason FROM ({_RAW}) WHERE bad IS NOT NULL")
def normalize_rejects(spark, sf_dir):
    return _raw(spark, sf_dir)[1].select("seq", "source_id", "field", "reason")


def _rights(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("source_id"), (k % 2 == 0).alias("can_fetch"), (k % 3 == 0).alias("can_store_metadata"), (k % 5 == 0).alias("can_ai_process"), F.when(k % 7 == 0, "APPROVED").otherwise("PENDING").alias("rights_review_status"), F.col("c_nationkey").alias("n"))


@_query("SELECT c_custkey AS source_id, c_custkey % 2 = 0 AS fetch, c_custkey % 3 = 0 AS store, c_custkey % 7 = 0 AND c_custkey % 5 = 0 AS model, c_custkey % 2 = 0 AND c_custkey % 3 = 0 AS admit FROM customer")
def rights_filters(spark, sf_dir):
    return _rights(spark, sf_dir).select("source_id", normalize.may_fetch().alias("fetch"), normalize.may_store().alias("store"), normalize.may_use_model().alias("model"), normalize.may_admit().alias("admit"))


@_query("SELECT 'classification-v2' AS version, c_custkey AS source_id FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'classification-v1', c_custkey FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 5 = 0")
def eligible_sources(spark, sf_dir):
    of = lambda v: normalize.eligible(_rights(spark, sf_dir), v).select(F.lit(v).alias("version"), "source_id")
    return of("classification-v2").unionByName(of("classification-v1"))


@_query("SELECT doc_id AS article_id, source AS source_id, n_chars AS discovered_at FROM documents WHERE source IN ('src1', 'src2', 'src0') AND n_chars >= 300 AND n_chars < 1500")
def article_scope(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), F.col("source").alias("source_id"), F.col("n_chars").alias("discovered_at"))
    return normalize.scope(rows, sources=["src1", "src2", "src0"], since=300, before=1500)


@_query("SELECT o_orderkey AS article_id, o_orderpriority AS prompt_version FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' ORDER BY o_orderkey LIMIT 1")
def lineage_mismatch(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("article_id"), F.when(F.col("o_orderstatus") == "F", "v2").otherwise("v1").alias("classifier_version"), F.lit("m").alias("requested_model"), F.col("o_orderpriority").alias("prompt_version"), F.lit("t").alias("taxonomy_version"))
    return normalize.lineage_mismatch(rows, "v2", {"requested_model": "m", "prompt_version": "1-URGENT", "taxonomy_version": "t"}).select("article_id", "prompt_version")


@_query("SELECT s_suppkey AS source_id, coalesce(CASE WHEN n_regionkey < 3 THEN 'HEALTHY' || n_regionkey END, 'UNKNOWN') AS health_status FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def flatten_source_state(spark, sf_dir):
    config = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), "s_nationkey")
    nations = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select("n_nationkey", F.concat(F.lit("HEALTHY"), _text("n_regionkey")).alias("health_status"))
    known = config.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("source_id", "health_status")
    return normalize.flatten_state(config.select("source_id"), known)


@_query("SELECT o_orderkey AS article_id, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey = 1")
def point_lookup(spark, sf_dir):
    return normalize.lookup(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("article_id"), "o_totalprice", "o_orderpriority"), article_id=1)


@_query("SELECT s_suppkey AS user_id, row_number() OVER (ORDER BY s_suppkey) - 1 AS place, (row_number() OVER (ORDER BY s_suppkey) - 1) // 7 AS page FROM supplier")
def preference_pages(spark, sf_dir):
    return normalize.all_pages(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id")), "user_id", 7).select("user_id", "place", "page")


@_query("SELECT count(*) AS sources FROM nation")
def distinct_sources(spark, sf_dir):
    """A repeated source would fail the query."""
    return normalize.distinct_or_fail(table(spark, sf_dir, "nation"), "n_nationkey").agg(F.count("*").alias("sources"))


_INPUT = "SELECT doc_id AS article_id, split_part(text, chr(10), 1) AS title, CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) END AS description, lang AS source_language, CASE WHEN doc_id % 2 = 0 THEN 'ENERGY,FINANCE' ELSE 'FINANCE' END AS source_domains FROM documents"


def _inputs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cut = F.instr("text", "\n")
    articles = docs.select(F.col("doc_id").alias("article_id"), F.concat(F.lit("s"), (F.col("doc_id") % 2).cast("string")).alias("source_id"), F.lit("http://hidden/").alias("url"), F.when(cut > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text")).alias("title"), F.when(cut > 0, F.expr("substring(text, instr(text, '\n') + 1)")).alias("description"), F.lit("US").alias("market"), F.col("lang").alias("language"))
    sources = spark.createDataFrame([("s0", ["FINANCE", "ENERGY"]), ("s1", ["FINANCE"])], "source_id string, domains array<string>").select("*", F.lit("GOVERNMENT").alias("source_type"), F.lit("PRIMARY").alias("authority_level"))
    return normalize.model_input(articles, sources)


@_query(f"SELECT article_id, sha256(coalesce(title, '')) AS title, sha256(coalesce(description, '')) AS description, source_language, source_domains, 'US' AS source_market, 'GOVERNMENT' AS source_type, 'PRIMARY' AS authority_level FROM ({_INPUT})")
def model_input(spark, sf_dir):
    short = lambda c: F.sha2(F.coalesce(c, F.lit("")), 256)
    return _inputs(spark, sf_dir).select("article_id", "input.*").select("article_id", short("title").alias("title"), short("description").alias("description"), "source_language", F.array_join("source_domains", ",").alias("source_domains"), "source_market", "source_type", "authority_level")


def _answer(batch: pd.DataFrame) -> pd.DataFrame:
    """A model that needs no network: it goes by a title's length."""
    n = batch["title"].map(lambda t: len(t or ""))
    return pd.DataFrame({
        "is_relevant": n % 3 != 0, "markets": [[] if k % 3 == 0 else ["US", "VN"] if k % 7 == 1 else ["US"] for k in n], "category": [None if k % 3 == 0 else "FINANCE" for k in n], "topics": [["AI"] if k % 3 == 1 else [] for k in n], "confidence": [2.0 if k % 11 == 4 else 0.5 for k in n],
        "prompt_tokens": n, "prompt_cache_hit_tokens": [k + 1 if k % 13 == 5 else 0 for k in n], "completion_tokens": 1, "failure": ["TIMEOUT" if k % 17 == 2 else None for k in n], "retryable": [True if k % 17 == 2 else None for k in n], "provider_attempts": 1,
    })


@_query(f"""SELECT article_id, CASE WHEN failure IS NULL THEN 'SUCCEEDED' ELSE 'FAILED' END AS outcome, failure AS failure_category, CASE WHEN failure IS NULL AND k % 3 <> 0 THEN 'US' WHEN failure IS NULL THEN '' END AS markets, CAST(k AS BIGINT) AS prompt_tokens FROM
(SELECT article_id, k, CASE WHEN k % 17 = 2 THEN 'TIMEOUT' WHEN k % 13 = 5 THEN 'INVALID_USAGE' WHEN k % 11 = 4 OR (k % 3 <> 0 AND k % 7 = 1) THEN 'INVALID_OUTPUT' END AS failure FROM (SELECT article_id, length(coalesce(title, '')) AS k FROM ({_INPUT})))""")
def model_adapter(spark, sf_dir):
    return model.apply_model(_inputs(spark, sf_dir), _answer).select("article_id", "outcome", "failure_category", F.array_join("markets", ",").alias("markets"), "prompt_tokens")


# Classification, discovery -----------------------------------------------------------------------
def _first_word(column, words):
    return "list_filter([" + ", ".join(f"CASE WHEN {_has(column, [w])} THEN '{w}' END" for w in sorted(words)) + "], lambda x: x IS NOT NULL)[1]" if words else "NULL"


def _evidence_sql():
    parts = []
    for c in RULES.categories:
        parts += [(c.name, "strong_title", _first_word("t", c.strong_title), 4, "true"), (c.name, "title_keyword", _first_word("t", c.title), 2, "true"), (c.name, "description_keyword", _first_word("d", c.description), 1, "true"), (c.name, "single_source_domain_prior", f"CASE WHEN only_domain = '{c.name}' THEN '' END", 2, "true")]
    for m in RULES.markets:
        parts += [(m.name, "source_market_prior", f"CASE WHEN m = '{m.name}' THEN '' END", 1, "clear"), (m.name, "title_keyword", _first_word("t", m.title), 2, "clear"), (m.name, "description_keyword", _first_word("d", m.description), 1, "clear")]
    each = " UNION ALL ".join(f"SELECT doc_id, '{s}' AS subject, '{k}' AS kind, {w} AS keyword, {p} AS points FROM s WHERE {cond}" for s, k, w, p, cond in parts)
    ranked = "list_reverse_sort([" + ", ".join(f"s_{c.name}" for c in RULES.categories) + "])"
    return f"WITH s AS (SELECT *, z[1] >= 4 AND z[1] - z[2] >= 2 AS clear FROM (SELECT *, {ranked} AS z FROM ({_sql_scores()}))) SELECT * FROM ({each}) WHERE keyword IS NOT NULL"


@_query(_evidence_sql())
def classify_evidence(spark, sf_dir):
    return classify.evidence(_keyed(spark, sf_dir), RULES, ["doc_id"]).select("doc_id", "subject", "kind", "keyword", "points")


@_query(f"WITH r AS (SELECT DISTINCT regexp_extract(canonical_url, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(canonical_url, '^[a-z]+://[^/]+(/[^/?]*)', 1) AS p FROM ({_CANON})), s AS (SELECT host, p FROM r UNION ALL SELECT DISTINCT host, p || '/1' FROM r) SELECT a.host AS hostname, a.p AS a, b.p AS b FROM s a JOIN s b ON a.host = b.host AND a.p <> b.p AND starts_with(rtrim(b.p, '/') || '/', rtrim(a.p, '/') || '/')")
def route_overlaps(spark, sf_dir):
    """Routes of every host by its pages' first folders, and one below each: what one covers another would shadow."""
    c = F.col("canonical_url")
    first = _canonical(spark, sf_dir).select(U.host_of(c).alias("hostname"), F.regexp_extract(c, "^[a-z]+://[^/]+(/[^/?]*)", 1).alias("path_prefix")).distinct()
    routes = first.unionByName(first.select("hostname", F.concat("path_prefix", F.lit("/1")).alias("path_prefix"))).withColumn("target_source_id", F.lit("s"))
    found = discovery.overlapping_routes(routes)
    return found.toDF("hostname", "a", "b")


@_query(f"SELECT page_id, canonical_url AS url, regexp_extract(canonical_url, '^[a-z]+://([^/:]+)', 1) AS hostname FROM ({_CANON})")
def observation_samples(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", discovery.sample_of(F.col("url")).alias("s"))
    return pages.select("page_id", "s.url", "s.hostname")


@_query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS second FROM events WHERE ts >= TIMESTAMP '2024-01-12 11:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'")
def lookback_window(spark, sf_dir):
    """The 73 hours before an end that isn't a whole second, and the second of each event."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    found = discovery.lookback(events, "ts", "2024-01-15 12:00:00.75", 73 * 60)
    return found.select("event_id", F.unix_timestamp(discovery.utc_second(F.col("ts"))).alias("second"))


@_query("SELECT user_id, count(*) AS cells_attempted, sum(length(props)) AS request_count, sum(CAST(floor(value) AS BIGINT)) AS raw_result_count, count(*) FILTER (WHERE value < 50) AS invalid_record_count, sum(event_id % 3) AS unique_candidate_count, sum(event_id % 2) AS admitted_count FROM events GROUP BY user_id")
def run_totals(spark, sf_dir):
    cells = table(spark, sf_dir, "events").select("user_id", F.length("props").alias("request_count"), F.floor("value").cast("long").alias("raw_result_count"), (F.col("value") < 50).cast("int").alias("invalid_record_count"), (F.col("event_id") % 3).alias("unique_candidate_count"), (F.col("event_id") % 2).alias("admitted_count"))
    return counters.run_totals(cells, ["user_id"])


@_query(f"""WITH w AS (SELECT count(*) AS w FROM ({_CLASSIFIED}) WHERE outcome = 'DETERMINISTIC'), p AS (SELECT count(*) AS p FROM customer), e AS (SELECT count(*) AS n FROM events), k AS (SELECT count(*) AS k FROM (SELECT DISTINCT user_id, event_type FROM events))
SELECT p AS preferences_loaded, CAST(greatest(1, ceil(p / 100)) AS BIGINT) AS preference_pages_read, CAST(greatest(1, ceil(w / 100)) AS BIGINT) AS work_pages_read, w AS work_items_seen, w * p AS pairs_evaluated, w * p - n AS no_match_count, k AS candidate_created_count, n - k AS candidate_already_exists_count FROM w, p, e, k""")
def matching_counters(spark, sf_dir):
    """Outcomes of events as candidates, beside the work and preferences that are matched."""
    outcomes = _candidate_outcomes(spark, sf_dir).select("outcome")
    return counters.matching(_work(spark, sf_dir), _preferences(spark, sf_dir), outcomes)


@_query("""SELECT o_orderpriority, count(*) AS claimed, count(*) FILTER (WHERE o_orderstatus = 'F') AS succeeded, count(*) FILTER (WHERE o_orderstatus = 'P') AS retry_scheduled, count(*) FILTER (WHERE o_orderstatus = 'O' AND o_custkey % 2 = 0) AS quarantined, count(*) FILTER (WHERE o_orderstatus = 'O' AND o_custkey % 2 = 1) AS lost_claim,
sum(o_orderkey % 4) AS provider_attempts, CAST(sum(o_custkey) AS DOUBLE) / 100 AS estimated_cost_usd FROM orders GROUP BY 1""")
def batch_counters(spark, sf_dir):
    outcome = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "P", "RETRY_SCHEDULED").when(F.col("o_custkey") % 2 == 0, "QUARANTINED").otherwise("LOST_CLAIM")
    items = table(spark, sf_dir, "orders").select("o_orderpriority", outcome.alias("outcome"), (F.col("o_orderkey") % 4).alias("provider_attempts"), (F.col("o_custkey") / F.lit(100)).cast("decimal(18,2)").alias("estimated_cost_usd"))
    return counters.batch(items, ["o_orderpriority"]).withColumn("estimated_cost_usd", F.col("estimated_cost_usd").cast("double"))


# Transitions -------------------------------------------------------------------------------------
def _candidate_outcomes(spark, sf_dir):
    """Events as candidates in order of arrival: a user and an event type make a pair."""
    name = F.concat_ws("/", F.lit("c"), _text("user_id"), "event_type")
    new = table(spark, sf_dir, "events").select(name.alias("candidate_id"), _text("user_id").alias("user_id"), F.col("event_type").alias("article_id"), F.col("event_id").alias("seq"))
    return match.record_candidates(new, new.limit(0).drop("seq"))


@_query("SELECT event_id AS seq, CASE WHEN event_id = f THEN 'CREATED' ELSE 'ALREADY_EXISTS' END AS outcome, f AS first_seq FROM (SELECT event_id, min(event_id) OVER (PARTITION BY user_id, event_type) AS f FROM events)")
def candidate_outcomes(spark, sf_dir):
    return _candidate_outcomes(spark, sf_dir).select("seq", "outcome", "first_seq")


@_query("""SELECT o_orderkey AS article_id, CASE WHEN o_orderkey % 2 = 1 THEN 'a row starts RETRYABLE without attempts' WHEN was IN ('SUCCEEDED', 'QUARANTINED') THEN 'a terminal row is final' ELSE was || ' to ' || now END AS why FROM
(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'RETRYABLE' WHEN 'O' THEN 'PROCESSING' ELSE 'SUCCEEDED' END AS was, CASE o_custkey % 3 WHEN 0 THEN 'PROCESSING' WHEN 1 THEN 'SUCCEEDED' ELSE 'QUARANTINED' END AS now FROM orders)
WHERE o_orderkey % 2 = 1 OR was = 'SUCCEEDED' OR (was = 'RETRYABLE' AND now = 'SUCCEEDED')""")
def transition_guard(spark, sf_dir):
    """Half of the orders are stored before, all of them after a step that set every status anew."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    key = [k.alias("article_id"), F.lit("v").alias("classifier_version")]
    was = F.when(F.col("o_orderstatus") == "F", "RETRYABLE").when(F.col("o_orderstatus") == "O", "PROCESSING").otherwise("SUCCEEDED")
    now = F.when(F.col("o_custkey") % 3 == 0, "PROCESSING").when(F.col("o_custkey") % 3 == 1, "SUCCEEDED").otherwise("QUARANTINED")
    before, after = orders.filter(k % 2 == 0).select(*key, was.alias("status"), F.lit(1).alias("attempt_count")), orders.select(*key, now.alias("status"), F.lit(2).alias("attempt_count"))
    return state.illegal_transitions(before, after).select("article_id", "why")


# Scalar functions and checks ---------------------------------------------------------------------
@_query(r"SELECT doc_id, source || ' ' || lang AS tidied, source || chr(9) || ' ' || upper(lang) AS identifier, lower(source) || ' ' || lang AS key, array_to_string(regexp_extract_all(text, '\p{Nd}+'), ',') AS numbers FROM documents")
def text_keys(spark, sf_dir):
    raw = F.concat(F.lit(" "), "source", F.lit("\t "), F.upper("lang"), F.lit("\n"))
    return table(spark, sf_dir, "documents").select("doc_id", T.tidy(F.concat(F.lit("\n "), "source", F.lit(" \t "), "lang")).alias("tidied"), T.stripped(raw).alias("identifier"), T.matching_key(raw).alias("key"), F.array_join(T.numeric_tokens(F.col("text")), ",").alias("numbers"))


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) ELSE strftime(o_orderdate, '%Y-%m-%d') END AS written, CAST((o_orderkey * 37) % 1440 AS BIGINT) AS minute FROM orders")
def date_parts(spark, sf_dir):
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("于"), F.year(day).cast("string"), F.lit("年"), F.month(day).cast("string"), F.lit("月"), F.dayofmonth(day).cast("string"), F.lit("日"))).otherwise(F.date_format(day, "yyyy-MM-dd"))
    at = F.unix_timestamp(day.cast("timestamp")) + F.col("o_orderkey") * 37 * 60 + 59
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.cjk_date(text).alias("written"), dates.minute_of_day(at).cast("long").alias("minute"))


_SETS = "SELECT c_custkey, list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'VN' END, CASE WHEN c_custkey % 3 = 0 THEN 'EU' END, CASE WHEN c_custkey % 5 = 0 THEN 'US' END, CASE WHEN c_custkey % 7 = 0 THEN 'XX' END], lambda x: x IS NOT NULL) AS m, list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'AI' END, CASE WHEN c_custkey % 3 = 0 THEN 'BANKING' END, CASE WHEN c_custkey % 5 = 0 THEN 'AI' END], lambda x: x IS NOT NULL) AS t FROM customer"


@_query(f"""SELECT c_custkey, NOT (c_custkey % 7 = 0) AND NOT (c_custkey % 3 = 0 AND c_custkey % 5 = 0) AS markets_ok, NOT (c_custkey % 5 = 0 AND (c_custkey % 2 = 0 OR c_custkey % 3 = 0)) AS topics_ok,
CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey % 4 = 0 AND len(m) > 0 ELSE c_nationkey % 3 <> 0 AND len(m) = 0 AND len(t) = 0 END AS consistent FROM ({_SETS}) JOIN customer USING (c_custkey)""")
def label_checks(spark, sf_dir):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    some = lambda *pairs: F.array_compact(F.array(*[F.when(k % d == 0, v) for d, v in pairs]))
    markets, topics = some((2, "VN"), (3, "EU"), (5, "US"), (7, "XX")), some((2, "AI"), (3, "BANKING"), (5, "AI"))
    category = F.when((n % 2 == 0) & (n % 4 == 0) | (n % 2 == 1) & (n % 3 == 0), "ENERGY")
    return table(spark, sf_dir, "customer").select(k, checks.canonical_markets(markets).alias("markets_ok"), checks.canonical_topics(topics).alias("topics_ok"), checks.consistent_labels(n % 2 == 0, category, markets, topics).alias("consistent"))


@_query("SELECT event_id, event_id % 9 IN (0, 1, 2) AS samples_ok, CASE event_id % 5 WHEN 1 THEN 'more than 20 keys' WHEN 2 THEN 'a blank key' WHEN 3 THEN 'a key longer than 64' WHEN 4 THEN 'a value longer than 512' END AS problem, CASE event_id % 5 WHEN 1 THEN 20 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE 1 END AS kept FROM events")
def row_bounds(spark, sf_dir):
    """Samples and remarks of nine and five makes, some of which stay within bounds."""
    one = '{"url":"u","hostname":"h","observed_at":"t"}'
    made = ["[]", f"[{one}]", f"[{one},{one},{one}]", f"[{one},{one},{one},{one}]", one, '[{"url":"u","hostname":"h"}]', '[{"url":1,"hostname":"h","observed_at":"t"}]', '[{"url":"u","hostname":"h","observed_at":"t","x":"y"}]', "[5]"]
    k = F.col("event_id")
    of = lambda *pairs: F.map_from_arrays(F.array(*[F.lit(a) for a, _ in pairs]), F.array(*[F.lit(b) for _, b in pairs]))
    remarks = F.when(k % 5 == 0, of(("a", "x"))).when(k % 5 == 1, of(*[(f"k{n:02d}", "x") for n in range(25)])).when(k % 5 == 2, of(("a", "x"), (" ", "y"))).when(k % 5 == 3, of(("k" * 65, "x"))).otherwise(of(("a", "v" * 513)))
    rows = table(spark, sf_dir, "events").select(k, F.element_at(F.array(*map(F.lit, made)), (k % 9 + 1).cast("int")).alias("samples"), remarks.alias("remarks"))
    return rows.select(k, checks.valid_samples(F.col("samples")).alias("samples_ok"), checks.metadata_problem(F.col("remarks")).alias("problem"), F.size(checks.bounded_metadata(F.col("remarks"))).alias("kept"))


# Sinks -------------------------------------------------------------------------------------------
@_query("SELECT '{\"lang\":' || coalesce('\"' || lang || '\"', 'null') || ',\"n\":' || n_chars || ',\"source\":\"' || source || '\"}' AS json, count(*) AS n FROM documents GROUP BY 1")
def contract_export(spark, sf_dir):
    """Records are written as a contract, found equal by a check, and read back."""
    rows = table(spark, sf_dir, "documents").select("source", F.col("n_chars").alias("n"), "lang", F.lit("inside").alias("created_at"))
    path = os.path.join(shared_folder(spark), f"contract-{uuid.uuid4().hex}")
    sinks.export_contract(normalize.published(rows, ["source", "n", "lang"]), ["source", "n", "lang"], path)
    if sinks.export_contract(rows, ["source", "n", "lang"], path, check=True):
        raise RuntimeError("the contract that was written differs")
    return sinks.dry_run(spark.read.text(path).withColumnRenamed("value", "json"), ["json"]).withColumnRenamed("count", "n")


def _stream(spark, sf_dir):
    fixed = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(fixed).parquet(f"{sf_dir}/events*.parquet")


@_query("SELECT CAST(user_id AS BIGINT) AS user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def stream_first_writes(spark, sf_dir):
    """Events as a stream into a first-write-wins table, which is read back."""
    folder = os.path.join(shared_folder(spark), f"stream-{uuid.uuid4().hex}")
    rows = _stream(spark, sf_dir).select("user_id", "event_type", "event_id")
    sinks.append_new(rows, f"{folder}/table", f"{folder}/state", ["user_id", "event_type"], "event_id").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select(F.col("user_id").cast("long").alias("user_id"), "event_type", "event_id")


@_query("""WITH e AS (SELECT *, CAST(ts AS DATE) AS dy FROM events), s AS (SELECT dy, event_type, event_id, row_number() OVER (PARTITION BY dy, event_type ORDER BY event_id) AS k FROM e WHERE value >= 50)
SELECT CAST(dy AS VARCHAR) AS observation_day, event_type, n AS observation_count, coalesce(x, '') AS samples FROM (SELECT dy, event_type, count(*) AS n FROM e GROUP BY ALL) LEFT JOIN (SELECT dy, event_type, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY k) AS x FROM s WHERE k <= 3 GROUP BY ALL) USING (dy, event_type)""")
def stream_daily_folds(spark, sf_dir):
    """Events as a stream into daily folds, batch by batch, which are read back as one."""
    folder = os.path.join(shared_folder(spark), f"stream-{uuid.uuid4().hex}")
    rows = _stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.append_folds(rows, f"{folder}/table", f"{folder}/state", ["event_type"], "ts", "event_id", F.when(F.col("value") >= 50, F.col("event_id").cast("string"))).awaitTermination()
    found = sinks.folds(spark, f"{folder}/table", ["event_type"])
    return found.select(F.col("observation_day").cast("string").alias("observation_day"), "event_type", "observation_count", F.array_join("samples", ",").alias("samples"))
