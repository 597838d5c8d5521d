"""Configuration catalogues (TOML) as small tables: sources, routes, queries, rules, prices.

Files are read by Spark, so any store that Spark reads will do; a catalogue is authored by hand, so
its rows may be on the driver.  Any invalid file fails the whole catalogue.
"""

from __future__ import annotations

import os
import re
import tomllib
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.classify import Category, Rules

# The vocabularies that catalogues use.
MARKETS = ("VN", "US", "EU", "CN")
DOMAINS = ("LAW_POLICY", "ENERGY", "TECHNOLOGY", "REAL_ESTATE", "FINANCE")
TOPICS = ("AI", "BANKING", "INTEREST_RATES", "OIL_GAS", "REAL_ESTATE", "REGULATION", "RENEWABLE_ENERGY", "SEMICONDUCTORS")
MODES = ("CANONICAL_URL_FALLBACK", "NATIVE_SOURCE_ITEM_ID_REQUIRED")

SOURCE = """source_id string, name string, market string, language string, source_type string, authority_level string, domains array<string>, priority int, content_scope string,
acquisition_method string, endpoint_url string, poll_interval_minutes int, max_requests int, period_seconds int,
can_fetch boolean, can_store_metadata boolean, can_store_full_text string, can_ai_process boolean, can_show_snippet string, can_redistribute_full_text boolean, rights_review_status string,
cost_type string, monthly_fixed_usd double"""
ROUTE = "hostname string, path_prefix string, target_source_id string, content_scope string, identity_mode string"
QUERY = "query_id string, provider string, market string, domain string, query_expression string"
PRICE = """pricing_id string, model string, window string, effective_from long, effective_until long, start_minute int, end_minute int,
hit_rate decimal(18,6), miss_rate decimal(18,6), output_rate decimal(18,6)"""


class CatalogueError(ValueError):
    """A catalogue that can't be used, and why."""


def _need(holds: bool, why: str) -> None:
    if not holds:
        raise CatalogueError(why)


def _files(spark: SparkSession, path: str) -> list[tuple[str, dict]]:
    """(name, content) of the TOML files at path, by name."""
    rows = spark.read.option("pathGlobFilter", "*.toml").text(path, wholetext=True).select(F.input_file_name().alias("path"), "value").collect()
    out = []
    for r in sorted(rows, key=lambda r: os.path.basename(r["path"])):
        try:
            out.append((os.path.basename(r["path"]).removesuffix(".toml"), tomllib.loads(r["value"])))
        except tomllib.TOMLDecodeError as e:
            raise CatalogueError(f"{r['path']}: {e}") from e
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def _entries(spark: SparkSession, path: str, key: str) -> list[dict]:
    """The tables under the only key of one file."""
    ((_, content),) = _files(spark, path)
    _need(set(content) <= {key} and isinstance(content.get(key, []), list), f"{path}: only an array of tables {key} is allowed")
    return content.get(key, [])


def _unique(rows: list[dict], *keys: str) -> None:
    seen = set()
    for r in rows:
        k = tuple(r[k] for k in keys)
        _need(k not in seen, f"repeated {'/'.join(map(str, k))}")
        seen.add(k)


def _flag(value) -> str | None:
    return str(value).lower() if isinstance(value, bool) else value


def _source(stem: str, c: dict) -> dict:
    _need(c.get("source_id") == stem and re.fullmatch(r"[a-z][a-z0-9_]{0,127}", stem) is not None, f"{stem}: source_id must be the file's name")
    _need(c.get("market") in MARKETS, f"{stem}: market")
    domains = c.get("domains", [])
    _need(bool(domains) and len(domains) == len(set(domains)) and set(domains) <= set(DOMAINS), f"{stem}: domains")
    cost, rights, get = c.get("cost", {}), c.get("rights", {}), c.get("acquisition", {})
    amount = cost.get("monthly_fixed_usd")
    _need(isinstance(amount, (int, float)) and not isinstance(amount, bool), f"{stem}: monthly_fixed_usd must be a number")
    _need(amount == 0 if cost.get("type") == "FREE" else amount > 0 or cost.get("type") != "FIXED_MONTHLY", f"{stem}: the cost contradicts its type")
    for k in ("can_fetch", "can_store_metadata", "can_ai_process", "can_redistribute_full_text"):
        _need(isinstance(rights.get(k), bool), f"{stem}: {k} must be true or false")
    for k in ("can_store_full_text", "can_show_snippet"):
        _need(isinstance(rights.get(k), bool) or rights.get(k) == "REVIEWED", f"{stem}: {k}")
    _need(isinstance(c.get("priority"), int) and not isinstance(c["priority"], bool) and c["priority"] >= 0, f"{stem}: priority")
    limit = get.get("rate_limit", {})
    return {k: c.get(k) for k in ("source_id", "name", "market", "language", "source_type", "authority_level", "domains", "priority", "content_scope")} | {
        "acquisition_method": get.get("method"), "endpoint_url": get.get("endpoint_url"), "poll_interval_minutes": get.get("poll_interval_minutes"), "max_requests": limit.get("max_requests"), "period_seconds": limit.get("period_seconds"),
        **{k: rights[k] for k in ("can_fetch", "can_store_metadata", "can_ai_process", "can_redistribute_full_text")}, "can_store_full_text": _flag(rights["can_store_full_text"]), "can_show_snippet": _flag(rights["can_show_snippet"]),
        "rights_review_status": rights.get("rights_review_status"), "cost_type": cost.get("type"), "monthly_fixed_usd": float(amount),
    }


def sources(spark: SparkSession, folder: str) -> DataFrame:
    """One row a file of the folder; none is an error."""
    rows = [_source(*f) for f in _files(spark, folder)]
    _need(bool(rows), f"{folder} holds no source")
    return spark.createDataFrame(rows, SOURCE)


def routes(spark: SparkSession, path: str | None, known: DataFrame) -> DataFrame:
    """Publisher routes; no file means no route.  Hosts and prefixes must be plain, targets known, prefixes of a host apart."""
    rows = [] if path is None or not _exists(spark, path) else _entries(spark, path, "routes")
    ids = {r["source_id"] for r in known.select("source_id").collect()}
    for r in rows:
        host, prefix = r.get("hostname", ""), r.get("path_prefix", "")
        _need(bool(host) and host == host.lower() and not re.search(r"[\s/?#]", host), f"hostname {host!r}")
        _need(prefix.startswith("/") and not re.search(r"[\s?#]", prefix), f"path_prefix {prefix!r}")
        _need(r.get("target_source_id") in ids, f"unknown source {r.get('target_source_id')}")
        _need(r.get("identity_mode") in MODES, f"identity_mode of {host}{prefix}")
    closed = lambda p: p if p.endswith("/") else p + "/"
    by_host: dict[str, list[str]] = {}
    for r in rows:
        by_host.setdefault(r["hostname"], []).append(closed(r["path_prefix"]))
    for host, prefixes in by_host.items():
        ordered = sorted(prefixes)  # what a prefix covers follows it directly
        for a, b in zip(ordered, ordered[1:]):
            _need(not b.startswith(a), f"routes of {host} overlap: {a} and {b}")
    return spark.createDataFrame(rows, ROUTE)


def queries(spark: SparkSession, path: str | None) -> DataFrame:
    """Discovery queries; null means that discovery is off, a missing or empty file is an error."""
    rows = []
    if path is not None:
        _need(_exists(spark, path), f"{path} does not exist")
        rows = _entries(spark, path, "queries")
        _need(bool(rows), f"{path} declares no query")
        _unique(rows, "query_id")
        _unique(rows, "market", "domain")
        for r in rows:
            _need(r.get("market") in MARKETS and r.get("domain") in DOMAINS and bool(str(r.get("query_expression", "")).strip()), f"query {r.get('query_id')}")
    return spark.createDataFrame(rows, QUERY)


def rules(spark: SparkSession, path: str, key) -> Rules:
    """Classification rules.  key turns a keyword into the form that texts are matched in."""
    ((_, c),) = _files(spark, path)
    for group, name, values in (("categories", "category", DOMAINS), ("markets", "market", MARKETS), ("topics", "topic", TOPICS)):
        _need(sorted(r[name] for r in c.get(group, [])) == sorted(values), f"{group} must define each value once")

    def words(r: dict, field: str) -> list[str]:
        out = [key(w) for w in r.get(field, [])]
        _need(bool(out) and all(out) and len(out) == len(set(out)), f"{field} of {r}")
        return out

    t = c["thresholds"]
    return Rules(
        [Category(r["category"], words(r, "strong_title"), words(r, "title_keywords"), words(r, "description_keywords")) for r in c["categories"]],
        [Category(r["market"], [], words(r, "title_keywords"), words(r, "description_keywords")) for r in c["markets"]],
        {r["topic"]: words(r, "keywords") for r in c["topics"]},
        t["min_category_score"], t["min_category_margin"], t["min_market_score"],
    )


def _instant(value) -> int | None:
    if value is None:
        return None
    _need(isinstance(value, datetime) and value.tzinfo is not None or not isinstance(value, date), f"{value} needs an offset")
    return int(value.timestamp())


def prices(spark: SparkSession, path: str) -> DataFrame:
    """One row a price window.  A schedule's windows tile the day; a model's schedules don't overlap and only the last is open."""
    rows, spans = [], {}
    for s in _entries(spark, path, "schedules"):
        start, end = _instant(s["effective_from"]), _instant(s.get("effective_until"))
        _need(end is None or end > start, f"{s['pricing_id']} ends before it starts")
        spans.setdefault(s["model"], []).append((start, end))
        windows = sorted(s.get("windows", []), key=lambda w: w["start_minute_utc"])
        edges = [0] + [w["end_minute_utc"] for w in windows]
        _need([w["start_minute_utc"] for w in windows] == edges[:-1] and edges[-1] == 1440, f"the windows of {s['pricing_id']} must tile the day")
        _unique(windows, "name")
        rows += [(s["pricing_id"], s["model"], w["name"], start, end, w["start_minute_utc"], w["end_minute_utc"], *[Decimal(w[f"{k}_usd_per_million"]) for k in ("input_cache_hit", "input_cache_miss", "output")]) for w in windows]
    _need(bool(rows), f"{path} holds no schedule")
    for model, of_model in spans.items():
        ordered = sorted(of_model)
        for (_, end), (start, _) in zip(ordered, ordered[1:]):
            _need(end is not None and end <= start, f"schedules of {model} overlap")
    return spark.createDataFrame(rows, PRICE)


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Sample files of either form: a bare array of records, or an object that has them under records."""
    texts = spark.read.text(path, wholetext=True)
    bare = F.ltrim("value").startswith("[")
    found = F.when(bare, F.from_json("value", f"array<struct<{_fields(schema)}>>")).otherwise(F.from_json("value", f"struct<records:array<struct<{_fields(schema)}>>>")["records"])
    return texts.select(F.inline(found))


def _fields(schema: str) -> str:
    """A column list in the form that struct<> takes."""
    return ",".join(f.simpleString() for f in StructType.fromDDL(schema))
