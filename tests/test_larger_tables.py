"""What larger tables bring: rows beyond a bound, text that smaller tables don't hold."""

from __future__ import annotations

import difflib
import random
import time

import duckdb
import pytest

from plumbline.functions import text as T
from plumbline.operators import dedup, match, normalize
from plumbline.plans import catalogue
from plumbline.sources import feeds


def test_visible_text_decodes_closed_references_only(spark, tmp_path):
    pages = ["<title>a &amp;&amp</title><h1>b&amp</h1>c", "<p>&lt;b&gt; &amp;amp; &amp;lt; &#39;&#x27; &copy;&copy &nbsp;x &", "<p>R&D &; &bogus; &notit; a&ltb<!-- & -->", None]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = dict(duck.execute(catalogue.oracle_sql()["html_visible_text"]).fetchall())
    assert want[0] == "a &&amp b&amp c"
    assert {r["page_id"]: r["text"] for r in catalogue.queries()["html_visible_text"](spark, str(tmp_path)).collect()} == want
    assert T._visible("<p>a&amp</p>b") == "a& b"  # normalisation reads references as HTML does


def test_pages_of_more_rows_than_a_task_numbers(spark, tmp_path, monkeypatch):
    """60,000 suppliers, as in the larger tables, and a few in many ranges."""
    spark.range(60_000).select((F.col("id") * 7 + 1).alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    got = [tuple(r) for r in catalogue.queries()["preference_pages"](spark, str(tmp_path)).orderBy("user_id").collect()]
    assert got == [(k * 7 + 1, k, k // 7) for k in range(60_000)]
    monkeypatch.setattr(normalize, "PLACE_ROWS", 3)
    names = spark.createDataFrame([(f"u{k * 37 % 101:03}",) for k in range(101)], "user_id string")
    assert [tuple(r) for r in normalize.all_pages(names, "user_id", 10).orderBy("user_id").collect()] == [(f"u{k:03}", k, k // 10) for k in range(101)]
    with pytest.raises(ValueError, match="exceeds 100"):
        normalize.all_pages(names, "user_id", 10, most=100)
    with pytest.raises(ValueError, match="repeated key"):
        normalize.all_pages(names.unionByName(names.limit(1)), "user_id", 10)


def test_paging_meets_the_pages_once(spark, sf):
    """A step that repeats those before it made 66 joins of eleven steps."""
    plan = catalogue.queries()["listing_paging"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 2


def test_paging_of_sources_with_many_pages(spark, monkeypatch):
    u = lambda s, k: f"https://{s}.org/l?p={k}"
    chains = {"a": [u("a", 1), u("a", 2), None], "b": [u("b", 1), u("b", 0)], "c": ["http://c.org/l"], "d": [u("d", k + 1) for k in range(14)], "e": [u("e", 1)], "f": [u("x", 1)]}
    stored = [(s, u(s, k), following, 0 if (s, k) == ("a", 1) else 4) for s, c in chains.items() for k, following in enumerate(c)] + [("c", "https://c.org/other", None, 4)] * 2
    pages = spark.createDataFrame(stored, "source_id string, url string, next_url string, n_items int")
    ends = spark.createDataFrame([(s, u(s, 0), 6 if s == "e" else 100) for s in [*chains, "none"]], "source_id string, endpoint string, max_items int")
    got = []
    for most in (10_000, 2, 0):
        monkeypatch.setattr(feeds, "WALK_PAGES", most)
        got.append(sorted((tuple(r) for r in feeds.follow(pages, ends, 5).collect()), key=repr))
    assert got[0] == got[1] == got[2]
    assert {(s, k): why for s, k, _, _, why in got[0] if why} == {
        ("a", 1): "a next page but no row", ("b", 1): "a loop", ("c", 0): "not https", ("d", 5): "too many pages", ("e", 1): "a page that isn't there", ("f", 0): "another origin", ("none", 0): "a page that isn't there",
    }
    assert [(k, n) for s, k, _, n, _ in got[0] if s in "de"] == [(0, 4), (1, 4), (2, 4), (3, 4), (4, 4), (5, 0), (0, 4), (1, 0)]


def test_alerts_of_more_users_than_a_dimension_has(spark, sf, monkeypatch):
    """Users come in teams, and their copies never pass through the driver."""
    monkeypatch.setattr(match, "DIMENSION_ROWS", 0)
    monkeypatch.setattr(match, "TEAM", 1, raising=False)
    df = catalogue.queries()["alert_match"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [max(x.find("+-"), x.find(":-")) for x in plan]
    for k, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = next((j for j in range(k + 1, len(plan)) if depth[j] <= depth[k]), len(plan))
            assert not any("_part#" in x for x in plan[k:below])
    duck = duckdb.connect()
    for t in ("documents", "customer"):
        duck.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = duck.execute(f"select user_id, article_id, reasons, importance, score, breaking, candidate_id from ({catalogue.oracle_sql()['alert_match']})").fetchall()
    got = [tuple(r) for r in df.select("user_id", "article_id", "reasons", "importance", "score", "breaking", "candidate_id").collect()]
    assert sorted(got) == sorted(want)


def test_alerts_move_articles_to_blocks_of_users(spark, sf, monkeypatch):
    """Pairs went to disk once for each team of 1,000 users of their set; now no exchange stands above the join that makes them."""
    queries = catalogue.queries()
    columns = ["user_id", "article_id", "reasons", "importance", "score", "breaking", "candidate_id"]
    want = sorted(tuple(r) for r in queries["alert_match"](spark, sf).select(*columns).collect())
    monkeypatch.setattr(match, "DIMENSION_ROWS", 0)
    monkeypatch.setattr(match, "TEAM", 2)
    monkeypatch.setattr(match, "BLOCK", 40, raising=False)
    df = queries["alert_match"](spark, sf).select(*columns)
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [max(x.find("+-"), x.find(":-")) for x in plan]
    meets = [k for k, x in enumerate(plan) if "Join" in x and "value#" in x and "wanted#" in x]
    assert meets
    for k, line in enumerate(plan):
        if "Exchange" in line:
            below = next((j for j in range(k + 1, len(plan)) if depth[j] <= depth[k]), len(plan))
            assert not any(k < j < below for j in meets)
    assert sorted(tuple(r) for r in df.collect()) == want


def test_ratio_of_long_titles_is_difflibs(monkeypatch):
    """Long near-copies took the product of their lengths; two titles of 20,000 characters are compared at once."""
    rng = random.Random(5)
    monkeypatch.setattr(dedup, "SHORT", 20)
    for k in range(150):
        a = "".join(rng.choices("ab" if k % 3 else "abcdefg ß", k=rng.randint(0, 90)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(b))
            b[i : i + rng.randint(0, 1)] = rng.choices("ab", k=rng.randint(0, 1))
        want = difflib.SequenceMatcher(None, a, "".join(b), autojunk=False).ratio()
        assert dedup.ratio(a, "".join(b)) == want
        assert want < 0.98 or dedup._shares_runs(a, "".join(b), 0.98)
    monkeypatch.setattr(dedup, "SHORT", 600)
    text = "".join(rng.choices("abcd", k=20_000))
    began = time.time()
    assert dedup.ratio(text, text[:7_000] + "x" + text[7_001:]) == 2 * 19_999 / 40_000
    assert not dedup._shares_runs(text, "".join(rng.choices("abcd", k=20_000)), 0.98) and time.time() - began < 10
