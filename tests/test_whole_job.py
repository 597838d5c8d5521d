"""Queries over whole tables, against brute force: no row is left out by its id, time or rarity."""

from __future__ import annotations

import difflib
import hashlib
import json
import re
import unicodedata

import pytest

from plumbline.operators import dedup
from plumbline.plans import catalogue


def test_alerts_reach_every_customer(spark, sf):
    queries = catalogue.queries()
    found = lambda k: k * 7_919 % 90_001  # noqa: E731  when a document is discovered
    articles = [r for r in queries["classify_route"](spark, sf).collect() if r["outcome"] == "DETERMINISTIC" and 90_000 - found(r["doc_id"]) <= 86_400]
    want = {}
    for c in spark.read.parquet(f"{sf}/customer.parquet").collect():
        k, n = c["c_custkey"], c["c_nationkey"]
        likes = {"market": [["US", "EU"], ["VN"], []][k % 3], "category": [["LAW_POLICY"], []][n % 2], "topic": [] if n % 5 else ["REGULATION", "AI"]}
        for a in articles:
            if a["source"] == f"src{k % 20}":
                continue
            has = {"market": a["markets"].split(","), "category": [a["category"]], "topic": a["topics"].split(",")}
            hit = {d: [x for x in ("VN", "US", "EU", "CN") if x in has[d] and x in likes[d]] if d == "market" else sorted(set(has[d]) & set(likes[d])) for d in likes}
            dims = sum(map(bool, hit.values()))
            if dims:
                raw = a["confidence"] * (dims / sum(map(bool, likes.values())))
                high = dims >= 2 and raw >= 0.9
                candidate = hashlib.sha256(f'["alert-candidate-v1","{k}","{a["doc_id"]}"]'.encode()).hexdigest()
                want[str(k), str(a["doc_id"])] = (",".join(f"{d}:{x}" for d in hit for x in hit[d]), "HIGH" if high else "NORMAL", round(raw, 6), k % 2 == 0 and high and 0 <= 90_000 - found(a["doc_id"]) <= 7_200, candidate)
    got = queries["alert_match"](spark, sf).collect()
    assert {(r["user_id"], r["article_id"]): (r["reasons"], r["importance"], r["score"], r["breaking"], r["candidate_id"]) for r in got} == want
    assert len(got) == len(want) and max(int(r["user_id"]) for r in got) >= 60


def brute_duplicates(rows):
    """seq: (duplicate_of, reason, score), comparing each row with all before it."""
    out = {}
    for k, a in enumerate(rows):
        out[a["seq"]] = (None, None, None)
        for b in rows[:k]:
            same = lambda *keys: all(a[c] is not None and a[c] == b[c] for c in keys)  # noqa: B023, E731
            reason = "CANONICAL_URL" if same("canonical_url") else "SOURCE_ITEM_ID" if same("source_id", "source_item_id") else "CONTENT_HASH" if same("content_hash") else None
            score = None
            x, y = a["title_key"], b["title_key"]
            if not reason and same("market") and min(len(x), len(y)) >= 30 and abs(a["at"] - b["at"]) <= 86_400 and 2 * min(len(x), len(y)) >= 0.98 * (len(x) + len(y)):
                m, n = re.findall(r"\d+", x), re.findall(r"\d+", y)
                if not m or not n or m == n:
                    score = difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
                    reason = "TITLE_SIMILARITY" if score >= 0.98 else None
            if reason:
                out[a["seq"]] = (b["seq"], reason, score if reason == "TITLE_SIMILARITY" else None)
                break
    return out


@pytest.mark.parametrize("cell_rows", [dedup.CELL_ROWS, 3])
def test_earliest_duplicate_of_all_layers(spark, monkeypatch, cell_rows):
    monkeypatch.setitem(dedup.earliest_title.__kwdefaults__, "cell_rows", cell_rows)
    say = lambda k: f"headline about the rate decision of bank number-{chr(97 + k % 3) * 3} in the town and elsewhere"
    rows = []
    for k in range(160):
        title = say(k) if k % 4 else say(k).replace("town", "tawn") if k % 8 else say(k) + f" {k % 5}"
        if k % 11 == 0 or k % 7 == 0 or k % 9 == 0:
            title = "short"
        rows.append((k, f"http://h/{k % 21}" if k % 7 == 0 else None, f"s{k % 5}", f"i{k % 45}" if k % 9 == 0 else None, f"c{k}" if k % 10 else "c", ("US", "EU")[k % 13 == 0], title, k * 40_009 % (9 * 86_400)))
    names = "seq canonical_url source_id source_item_id content_hash market title_key at".split()
    df = spark.createDataFrame(rows, "seq long, canonical_url string, source_id string, source_item_id string, content_hash string, market string, title_key string, at long")
    want = brute_duplicates([dict(zip(names, r, strict=True)) for r in rows])
    assert {r for _, r, _ in want.values()} == {None, "CANONICAL_URL", "SOURCE_ITEM_ID", "CONTENT_HASH", "TITLE_SIMILARITY"}
    assert {r["seq"]: (r["duplicate_of"], r["reason"], r["score"]) for r in dedup.all_layers(df).collect()} == want


def test_title_query_by_brute_force(spark, sf):
    urls = {r["page_id"]: r["canonical_url"] for r in catalogue.queries()["url_canonicalize"](spark, sf).collect()}
    rows = []
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        title, feed, rest = r["text"].partition("\n")
        url = urls.get(r["doc_id"])
        item = re.search("/([0-9]+)", url or "")
        key = " ".join(unicodedata.normalize("NFC", title).casefold().split())
        sha = hashlib.sha256(json.dumps(["v1", title, *([rest] if feed else [])], separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
        rows.append({"seq": r["doc_id"], "canonical_url": url, "source_id": re.match("[a-z]+://([^/:]+)", url)[1] if url else r["source"], "source_item_id": item and item[1], "content_hash": sha, "market": r["lang"], "title_key": key, "at": r["doc_id"] * 7_919 % (7 * 86_400)})
    want = brute_duplicates(rows)
    assert any(reason == "TITLE_SIMILARITY" and seq - of > 24 for seq, (of, reason, _) in want.items())
    assert {r["seq"]: (r["duplicate_of"], r["reason"], r["score"]) for r in catalogue.queries()["dedup_decision"](spark, sf).collect()} == want


@pytest.mark.parametrize("name", ["queue_renew", "queue_complete", "queue_fail_transition"])
def test_commands_without_a_stored_row_lose_the_claim(spark, sf, name):
    keys = {r["o_orderkey"] for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey").collect()}
    got = {r["article_id"]: r for r in catalogue.queries()[name](spark, sf).collect()}
    assert set(got) == keys and any(k % 2 for k in keys)
    assert {got[k]["outcome"] for k in keys if k % 2} == {"LOST_CLAIM"}
    assert len({got[k]["outcome"] for k in keys if k % 2 == 0}) > 1
    assert all(got[k][-1] is None for k in keys if k % 2)
