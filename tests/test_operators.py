"""Boundary vectors of single operators."""

from __future__ import annotations

import hashlib
import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions import url as U
from plumbline.functions import dates
from plumbline.operators import dedup, discovery, match, normalize, state


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_canonical_urls(spark):
    c = lambda u: one(spark, u, U.canonicalize)
    assert c("HTTPS://News.Example.ORG:443/A?b=%2F&&b=&flag&UTM_Source=x&fbclid=1#top") == "https://news.example.org/A?b=%2F&&b=&flag"
    assert c("http://h?%75tm_campaign=1&%ZZ=2") == "http://h/?%ZZ=2"
    assert c("http://[2001:DB8::1]:8080/x") == "http://[2001:db8::1]:8080/x"
    for bad in ("/relative", "ftp://h/x", "http://u:p@h/", "http://h:99999/", "http://h/a b", "http://", None):
        assert c(bad) is None


def test_text(spark):
    assert one(spark, "<p>A&amp;amp;B<script>x</script><br>c&nbsp;d", T.visible_text) == "A&amp;B c d"
    assert one(spark, " Straße  É ", T.text_key) == "strasse é"
    has = lambda t, k: one(spark, t, lambda x: T.any_keyword(x, [k]))
    assert has("a law, b", "law") and not has("lawful", "law") and not has("luật", "lu")


TITLES = "seq long, market string, title_key string, at long, below long"


def test_title_similarity_boundaries(spark):
    long = "a very long headline about the rate decision of the bank"
    rows = [(1, "US", long, 0), (2, "US", long, 86_400), (3, "US", long, 2 * 86_400 + 1), (4, "EU", long, 0), (5, "US", long + " 7", 10), (6, "US", "short", 0), (7, "US", "short", 0)]
    got = {r["seq"]: r["of"] for r in dedup.earliest_title(spark.createDataFrame([(*r, r[0]) for r in rows], TITLES)).collect()}
    assert got[2] == 1 and 3 not in got and 4 not in got and 7 not in got


def test_many_copies_of_one_title(spark):
    """Ten thousand equal titles at as many times: running minima, no pairs."""
    title = "the same headline about the very same rate decision of the bank"
    rows = [(k, "US", title, (k * 7_919) % (5 * 86_400), k) for k in range(10_000)]
    began = time.time()
    got = {r["seq"]: r["of"] for r in dedup.earliest_title(spark.createDataFrame(rows, TITLES)).collect()}
    assert time.time() - began < 40
    at = {r[0]: r[3] for r in rows}
    for k in range(0, 10_000, 997):
        first = min((j for j in range(k) if abs(at[j] - at[k]) <= 86_400), default=None)
        assert got.get(k) == first


def test_match_boundaries(spark):
    work = "article_id string, source_id string, markets array<string>, category string, topics array<string>, confidence double, published_at long, discovered_at long, matched_at long"
    prefs = "user_id string, markets array<string>, categories array<string>, topics array<string>, muted_source_ids array<string>, muted_topics array<string>, breaking_alert_enabled boolean"
    w = spark.createDataFrame([("fresh", "s", ["VN", "US"], "ENERGY", ["AI"], 0.9, None, 0, 86_400), ("stale", "s", ["US"], "ENERGY", [], 0.9, None, 0, 86_401), ("future", "s", ["US"], "ENERGY", [], 0.8999996, 200, 100, 150), ("muted", "m", ["US"], "ENERGY", [], 0.9, None, 100, 150)], work)
    p = spark.createDataFrame([("u", ["US", "VN"], ["ENERGY"], [], ["m"], ["OIL"], True), ("empty", [], [], [], [], [], True)], prefs)
    got = {r["article_id"]: r for r in match.match(w, p).collect()}
    assert set(got) == {"fresh", "future"}
    assert got["fresh"]["reasons"] == ["market:VN", "market:US", "category:ENERGY"] and got["fresh"]["importance"] == "HIGH" and not got["fresh"]["breaking"]
    assert got["future"]["importance"] == "NORMAL" and got["future"]["score"] == 0.9  # no promotion by rounding


def test_folds_merge_and_prune(spark):
    e = spark.createDataFrame([(k, f"2024-01-0{d} 10:00:0{k}", "a", f"s{k}" if k != 2 else None) for d in (1, 2) for k in range(6)], "seq long, t string, key string, s string").withColumn("t", F.col("t").cast("timestamp"))
    fold = lambda x: discovery.fold_daily(x, ["key"], "t", "seq", F.col("s"))
    whole = {tuple(map(str, r)) for r in fold(e).select("observation_day", "observation_count", "samples").collect()}
    merged = discovery.merge_folds(fold(e.filter("seq < 3")), fold(e.filter("seq >= 3")), ["key"])
    assert {tuple(map(str, r)) for r in merged.select("observation_day", "observation_count", "samples").collect()} == whole
    kept = {str(r["observation_day"]): r["samples"] for r in discovery.prune(fold(e), "2024-01-01", "2024-01-02").collect()}
    assert kept == {"2024-01-01": [], "2024-01-02": ["s0", "s1", "s3"]}


def test_tiers(spark):
    f = lambda d, n, a, b: spark.range(1).select(discovery.tier(*map(F.lit, (d, n, a, b))).alias("t")).first()["t"]
    assert [f(13, 50, 1.0, 1.0), f(14, 49, 1.0, 1.0), f(14, 50, 0.99, 0.96), f(14, 50, 0.9, 0.97), f(14, 50, 0.8, 0.9), f(14, 50, 0.7, 1.0)] == ["INSUFFICIENT_DATA", "INSUFFICIENT_DATA", "GREEN_B", "GREEN_A", "YELLOW", "RED"]


def test_claims(spark):
    s = spark.createDataFrame([("a", "RETRYABLE", 5, None, 1, 0), ("b", "PROCESSING", None, 4, 1, 3), ("c", "RETRYABLE", 50, None, 1, 0), ("d", "SUCCEEDED", None, None, 1, 1)], "article_id string, status string, next_attempt_at long, lease_expires_at long, created_at long, attempt_count long").withColumn("max_attempts", F.lit(3))
    claimed = state.claim(s, 10, 5, 300, "run").orderBy("article_id")
    assert [(r["article_id"], r["outcome"], r["status"], r["attempt_count"], r["lease_expires_at"], r["error"]) for r in claimed.collect()] == [("a", "CLAIMED", "PROCESSING", 1, 310, None), ("b", "RECOVERED_QUARANTINED", "QUARANTINED", 3, None, "lease_expired_attempt_budget_exhausted")]
    tokens = [r["claim_token"] for r in claimed.collect()]
    assert tokens[0] and tokens[1] is None and tokens == [r["claim_token"] for r in claimed.collect()] != [r["claim_token"] for r in state.claim(s, 10, 5, 300, "other").orderBy("article_id").collect()]
    for bad in ((20, "run"), (901, "run"), (300, "")):
        with pytest.raises(ValueError):
            state.claim(s, 10, 5, *bad)


COMMAND = "article_id string, classifier_version string, claim_token string, category string, http_status int, retryable boolean, disposition string, provider_attempts int, prompt_tokens long, prompt_cache_hit_tokens long, prompt_cache_miss_tokens long, completion_tokens long, total_tokens long, estimated_cost_usd decimal(24,12)"
STORED = "article_id string, classifier_version string, status string, claim_token string, lease_expires_at long, attempt_count int, max_attempts int, prompt_tokens long, prompt_cache_hit_tokens long, prompt_cache_miss_tokens long, completion_tokens long, total_tokens long, estimated_cost_usd decimal(24,12)"


def test_failures_are_fenced(spark):
    use, zero = (12, 6, 6, 8, 20, None), (1, 1, 0, 1, 2, None)
    stored = spark.createDataFrame([("a", "v", "PROCESSING", "t", 100, 1, 3, *zero), ("b", "v", "PROCESSING", "t", 100, 3, 3, *zero), ("c", "v", "PROCESSING", "t", 9, 1, 3, *zero), ("d", "v", "SUCCEEDED", "t", 100, 1, 3, *zero)], STORED)
    command = lambda k, token="t", **x: (k, "v", token, *[x.get(n, d) for n, d in (("category", "TIMEOUT"), ("http_status", None), ("retryable", True), ("disposition", "RETRY_60_MINUTES"), ("provider_attempts", 1))], *x.get("use", use))
    run = lambda *rows: {r["article_id"]: tuple(r)[2:5] + (r["total_tokens"],) for r in state.fail(spark.createDataFrame(list(rows), COMMAND), stored, 10).collect()}
    got = run(command("a"), command("b"), command("c"), command("d"), command("e"))
    assert got["a"] == ("RETRY_SCHEDULED", "TIMEOUT", 3610, 22) and got["b"] == ("QUARANTINED", "attempt_budget_exhausted", None, 22)
    assert got["c"] == got["d"] == ("LOST_CLAIM", None, None, 2) and got["e"] == ("LOST_CLAIM", None, None, None)
    assert run(command("a", "x"))["a"][0] == "LOST_CLAIM" and run(command("a", retryable=False))["a"][:2] == ("QUARANTINED", "TIMEOUT")
    for bad in ({"category": ""}, {"http_status": 99}, {"retryable": None}, {"disposition": "LATER"}, {"provider_attempts": 4}, {"use": (12, 6, 5, 8, 20, None)}, {"use": (-1, -1, 0, 1, 0, None)}):
        with pytest.raises(Exception, match="fail|categor|HTTP|retryable|disposition|usage"):
            run(command("a", **bad))


def test_each_use_has_one_price(spark):
    schedule = spark.createDataFrame([("p", "m", "all", 0, 100, 0, 1440, 1, 2, 3), ("q", "m", "all", 200, None, 0, 1440, 5, 5, 5), ("r", "n", "all", 0, None, 0, 1440, 7, 7, 7)], "pricing_id string, model string, window string, effective_from long, effective_until long, start_minute int, end_minute int, hit_rate int, miss_rate int, output_rate int")
    use = lambda *rows: state.price(spark.createDataFrame([(k, m, at, 10, 20, 30) for k, (m, at) in enumerate(rows)], "usage_id int, model string, at long, hit long, miss long, output long"), schedule).orderBy("usage_id").collect()
    assert [(r["pricing_id"], float(r["cost"])) for r in use(("m", 99), ("n", 99), ("m", 200))] == [("p", 0.00014), ("r", 0.00042), ("q", 0.0003)]
    for gap in (("m", 150), ("x", 1), (None, 1)):
        with pytest.raises(Exception, match="expected one price"):
            use(gap)
    with pytest.raises(Exception, match="found 2"):
        state.price(spark.createDataFrame([(1, "n", 5, 1, 1, 1)], "usage_id int, model string, at long, hit long, miss long, output long"), schedule.unionByName(schedule)).collect()


def test_matches_before_their_time(spark):
    work = "article_id string, source_id string, markets array<string>, category string, topics array<string>, confidence double, published_at long, discovered_at long, matched_at long, classified_at long, is_relevant boolean"
    p = spark.createDataFrame([("u", ["US"], [], [], [], [], True)], "user_id string, markets array<string>, categories array<string>, topics array<string>, muted_source_ids array<string>, muted_topics array<string>, breaking_alert_enabled boolean")
    run = lambda *row: match.match(spark.createDataFrame([row], work), p).collect()
    assert len(run("a", "s", ["US"], None, [], 0.9, None, 5, 10, 6, True)) == 1 and run("a", "s", ["US"], None, [], 0.9, None, 5, 10, 6, False) == []
    for bad in ((11, 6), (5, 11)):
        with pytest.raises(Exception, match="lies before"):
            run("a", "s", ["US"], None, [], 0.9, None, bad[0], 10, bad[1], True)


def test_matches_alike_where_nothing_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(match, "DIMENSION_ROWS", 0)
    test_match_boundaries(spark)


def test_package_reaches_workers_from_any_folder(tmp_path):
    """A driver started elsewhere, without the package on any path of the workers."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from plumbline.session import local_session; s = local_session('x', cpus='2'); print('rows', e.queries()['html_visible_text'](s, '/root/testdata/sf0.001').count(), len(e.queries()['dedup_decision'](s, '/root/testdata/sf0.001').collect()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=300)
    assert "rows " in out.stdout and out.returncode == 0, out.stderr[-2000:]


def test_visible_text_and_identifiers(spark):
    v = lambda x: one(spark, x, T.visible_text)
    assert v("a<hr>b<form>c</form>") == "abc" and v("x<tbody>y") == "x y" and v("a<style>b</style>&lt;") == "a<"
    assert one(spark, " a  b\t", T.stripped) == "a  b" and one(spark, " \n", T.stripped) is None and one(spark, None, T.stripped) is None
    for text in (" Straße  É\n", "A  b\x1c\tC", "ΑΣ", ""):
        assert one(spark, text, T.matching_key) == one(spark, text, T.text_key)


def test_published_at(spark):
    cases = [
        ("x", "2026-07-13T10:00:00+02:00", "2026-07-13 08:00:00"), ("x", "2026-07-13T10:00:00.250Z", "2026-07-13 10:00:00.25"), ("x", "2026-07-13", None), ("x", "2026-07-13T10:00:00", None),
        ("x", "Mon, 13 Jul 2026 10:00:00 -0500", "2026-07-13 15:00:00"), ("x", "13 Jul 2026 10:00 GMT", "2026-07-13 10:00:00"), ("x", "Mon, 13 Jul 2026 10:00:00 -0000", None), ("x", "Mon, 13 Jul 2026 10:00:00 EDT", "2026-07-13 14:00:00"),
        ("us_fhfa_regulatory", "7/13/2026", "2026-07-13 04:00:00"), ("us_fhfa_regulatory", "01/13/2026", "2026-01-13 05:00:00"), ("us_fhfa_regulatory", "13/01/2026", None), ("eu_esma_regulatory", "13/07/2026", "2026-07-12 22:00:00"),
        ("cn_miit_policy_listing", "2026-07-13", "2026-07-12 16:00:00"), ("vn", " 13/7/2026 | 10:00:05 ", "2026-07-13 03:00:05"), ("vn", "13/7/2026 10:00:05", "2026-07-13 03:00:05"), ("vn", "31/02/2026", None), ("vn", "", None), ("vn", None, None),
    ]
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, s string, raw string, want string")
    got = rows.select("k", dates.published_at(F.col("raw"), F.col("s")).cast("string").alias("at")).orderBy("k").collect()
    assert [r["at"] for r in got] == [c[2] for c in cases]
    assert [one(spark, t, dates.cjk_date) for t in ("于2026年7月1日", "2026-07-01", "x", None)] == ["2026-7-1", "2026-07-01", None, None]


def test_normalize(spark):
    sources = spark.createDataFrame([("s", "US", "en")], "source_id string, market string, language string")
    raw = spark.createDataFrame([
        (1, "s", " id ", "HTTP://H.org?utm_x=1", "<b>A</b>&amp;B", "", "13/07/2026", " "), (2, "s", None, "ftp://h", "T", None, None, None), (3, "s", None, "http://h/", " <script>x</script>", None, None, "vi"),
        (4, "t", None, "http://h/", "T", None, None, None), (5, "s", "", "http://h/", "T", "<p>d", None, "vi"), (6, "s", None, None, None, None, None, None),
    ], "seq long, source_id string, source_item_id string, url string, title string, description string, published_at_raw string, language_hint string").withColumn("retrieved_at", F.lit("2026-07-14").cast("timestamp"))
    good, bad = normalize.normalize(raw, sources)
    g = {r["seq"]: r for r in good.collect()}
    assert set(g) == {1, 5} and {(r["seq"], r["field"]) for r in bad.collect()} == {(2, "url"), (3, "title"), (4, "source_id"), (6, "url")}
    sha = lambda x: hashlib.sha256(json.dumps(x, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert g[1]["article_id"] == sha(["v1", "source_item_id", "s", "id"]) and g[1]["content_hash"] == sha(["v1", "A&B", None]) and (g[1]["language"], g[1]["title"], g[1]["description"]) == ("en", "A&B", None)
    assert g[5]["article_id"] == sha(["v1", "canonical_url", "s", "http://h/"]) and g[5]["language"] == "vi" and g[5]["published_at"] is None
    assert normalize.normalize(raw.limit(0), sources)[0].isEmpty()
    assert [r["seq"] for r in normalize.first_of_each(raw, 2).orderBy("seq").collect()] == [1, 2, 4]


def test_queue_guards(spark):
    row = "article_id string, classifier_version string, status string, attempt_count int"
    before = spark.createDataFrame([("a", "v", "RETRYABLE", 0), ("b", "v", "SUCCEEDED", 1), ("c", "v", "RETRYABLE", 0), ("d", "v", "QUARANTINED", 3), ("e", "v", "PROCESSING", 1)], row)
    after = spark.createDataFrame([("a", "v", "PROCESSING", 1), ("b", "v", "SUCCEEDED", 2), ("c", "v", "SUCCEEDED", 1), ("e", "v", "PROCESSING", 1), ("f", "v", "RETRYABLE", 0), ("g", "v", "PROCESSING", 1)], row)
    assert {r["article_id"] for r in state.illegal_transitions(before, after).collect()} == {"b", "c", "d", "g"}


def test_routes_and_policy(spark):
    r = spark.createDataFrame([("h", "/a", "s"), ("h", "/a/b", "t"), ("g", "/a", "s"), ("h", "/c", "s")], "hostname string, path_prefix string, target_source_id string")
    assert [tuple(x) for x in discovery.overlapping_routes(r).collect()] == [("h", "/a", "/a/b")]
    folds = spark.createDataFrame([("2026-01-01", ["x"]), ("2026-01-02", ["x"]), ("2026-01-03", []), ("2026-01-05", ["x"])], "d string, samples array<string>").withColumn("observation_day", F.to_date("d"))
    evidence = spark.createDataFrame([("2026-01-01",), ("2026-01-04",)], "d string").select(F.to_date("d").alias("evidence_day"))
    assert tuple(discovery.prune_counts(folds, evidence, "2026-01-02", "2026-01-05", "2026-01-04").first()) == (1, 1, 1)


def test_candidate_outcomes(spark):
    of = lambda *rows: spark.createDataFrame(list(rows), "candidate_id string, user_id string, article_id string, seq long")
    stored = of(("c1", "u", "a", 0)).drop("seq")
    got = match.record_candidates(of(("c1", "u", "a", 0), ("c2", "u", "b", 1), ("c2", "u", "b", 2)), stored)
    assert {r["seq"]: r["outcome"] for r in got.collect()} == {0: "ALREADY_EXISTS", 1: "CREATED", 2: "ALREADY_EXISTS"}
    for bad in (of(("c9", "u", "a", 0)), of(("c1", "u", "b", 0))):
        with pytest.raises(Exception, match="candidate id"):
            match.record_candidates(bad, stored).collect()
