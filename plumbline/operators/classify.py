"""Rule classification: versioned keyword lists, scores, a confident label or none, and routing."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import any_keyword, first_keyword

MARKETS = ("VN", "US", "EU", "CN")


@dataclass
class Category:
    name: str
    strong_title: list[str] = field(default_factory=list)
    title: list[str] = field(default_factory=list)
    description: list[str] = field(default_factory=list)


@dataclass
class Rules:
    categories: list[Category]
    markets: list[Category]
    topics: dict[str, list[str]]
    least_score: int = 4
    least_margin: int = 2
    least_market: int = 2
    most_topics: int = 5


def _once(rows: DataFrame, found: Column) -> DataFrame:
    """rows with the fields of a struct, worked out once a row: a generator stands between its expressions and
    whatever is built on them, so neither filters nor projections copy them."""
    return rows.select("*", F.inline(F.array(found)))


def _tests(rules: Rules, title: Column, description: Column) -> Column:
    """One test for each keyword list, as a struct of booleans."""
    one = []
    for k, c in enumerate(rules.categories):
        one += [any_keyword(title, c.strong_title).alias(f"_c{k}_strong"), any_keyword(title, c.title).alias(f"_c{k}_title"), any_keyword(description, c.description).alias(f"_c{k}_description")]
    for k, m in enumerate(rules.markets):
        one += [any_keyword(title, m.title).alias(f"_m{k}_title"), any_keyword(description, m.description).alias(f"_m{k}_description")]
    one += [(any_keyword(title, words) | any_keyword(description, words)).alias(f"_t{k}") for k, (_, words) in enumerate(sorted(rules.topics.items()))]
    return F.struct(*one)


def _tested(rows: DataFrame, rules: Rules) -> DataFrame:
    return _once(rows, _tests(rules, F.coalesce("title_key", F.lit("")), F.coalesce("description_key", F.lit(""))))


def _points(k: int, c: Category) -> Column:
    """4 for a strong phrase and 2 for a keyword in the title, 1 in the description, 2 for a source of this domain alone."""
    one = lambda cond, points: F.when(cond, points).otherwise(0)
    return one(F.col(f"_c{k}_strong"), 4) + one(F.col(f"_c{k}_title"), 2) + one(F.col(f"_c{k}_description"), 1) + one(F.coalesce(F.col("only_domain") == c.name, F.lit(False)), 2)


def scores(rows: DataFrame, rules: Rules) -> DataFrame:
    """rows (title_key, description_key, only_domain) with the score of each category under its name in small letters."""
    return _tested(rows, Rules(rules.categories, [], {})).select(*rows.columns, *[_points(k, c).alias(c.name.lower()) for k, c in enumerate(rules.categories)])


def classify(rows: DataFrame, rules: Rules) -> DataFrame:
    """rows (title_key, description_key, source_market, only_domain) with top and second score, category, markets, topics, confidence and route."""
    tested = _tested(rows, rules)
    ranked = F.array_sort(F.array(*[F.struct((-_points(k, c)).alias("minus"), F.lit(c.name).alias("name")) for k, c in enumerate(rules.categories)]))
    content = lambda k: F.when(F.col(f"_m{k}_title"), 2).otherwise(0) + F.when(F.col(f"_m{k}_description"), 1).otherwise(0)
    prior = lambda name: F.when(F.coalesce(F.col("source_market") == name, F.lit(False)), 1).otherwise(0)
    chosen = {m.name: F.when((content(k) > 0) & (content(k) + prior(m.name) >= rules.least_market), m.name) for k, m in enumerate(rules.markets)}
    markets = F.array_compact(F.array(*[chosen[m] for m in MARKETS if m in chosen]))
    topics = F.slice(F.array_compact(F.array(*[F.when(F.col(f"_t{k}"), name) for k, name in enumerate(sorted(rules.topics))])), 1, rules.most_topics)
    found = _once(tested.select(*rows.columns, ranked.alias("_ranked"), markets.alias("_markets"), topics.alias("_topics")), F.struct((-F.col("_ranked")[0]["minus"]).alias("top"), (-F.col("_ranked")[1]["minus"]).alias("second")))
    sure = (F.col("top") >= rules.least_score) & (F.col("top") - F.col("second") >= rules.least_margin) & (F.size("_markets") > 0)
    confidence = F.least(F.lit(0.99), F.round(0.70 + 0.03 * F.least("top", F.lit(8)) + 0.02 * F.least(F.col("top") - F.col("second"), F.lit(6)), 2))
    none = F.expr("cast(array() as array<string>)")
    return found.select(
        *rows.columns, "top", "second", F.when(sure, F.col("_ranked")[0]["name"]).alias("category"), F.when(sure, F.col("_markets")).otherwise(none).alias("markets"),
        F.when(sure, F.col("_topics")).otherwise(none).alias("topics"), F.when(sure, confidence).alias("confidence"), F.when(sure, "CONFIDENT").otherwise("AMBIGUOUS").alias("route"),
    )


def evidence(rows: DataFrame, rules: Rules, keys: list[str]) -> DataFrame:
    """What speaks for each label of a row: keys, seq, subject, kind, keyword (the first by name), points.

    Markets are looked at only where the categories leave no doubt, as classification stops before them elsewhere.
    """
    t, d = F.coalesce("title_key", F.lit("")), F.coalesce("description_key", F.lit(""))
    said = lambda subject, kind, keyword, points: F.when(keyword.isNotNull(), F.struct(F.lit(subject).alias("subject"), F.lit(kind).alias("kind"), keyword.alias("keyword"), F.lit(points).alias("points")))
    given = lambda cond: F.when(F.coalesce(cond, F.lit(False)), F.lit(""))
    about = []
    for c in rules.categories:
        about += [said(c.name, "strong_title", first_keyword(t, c.strong_title), 4), said(c.name, "title_keyword", first_keyword(t, c.title), 2), said(c.name, "description_keyword", first_keyword(d, c.description), 1)]
        about.append(said(c.name, "single_source_domain_prior", given(F.col("only_domain") == c.name), 2))
    where = []
    for m in rules.markets:
        where += [said(m.name, "source_market_prior", given(F.col("source_market") == m.name), 1), said(m.name, "title_keyword", first_keyword(t, m.title), 2), said(m.name, "description_keyword", first_keyword(d, m.description), 1)]
    found = _once(rows.select(*keys, "title_key", "description_key", "only_domain", "source_market"), F.struct(F.array_compact(F.array(*about)).alias("_about"), F.array_compact(F.array(*where)).alias("_where")))
    points = lambda name: F.aggregate(F.filter("_about", lambda e: e["subject"] == name), F.lit(0), lambda acc, e: acc + e["points"])
    ranked = F.sort_array(F.array(*[points(c.name) for c in rules.categories]), asc=False)
    clear = (ranked[0] >= rules.least_score) & (ranked[0] - ranked[1] >= rules.least_margin)
    rest = F.when(clear, F.col("_where")).otherwise(F.slice("_where", 1, 0))
    return found.select(*keys, F.posexplode(F.concat("_about", rest)).alias("seq", "e")).select(*keys, "seq", "e.*")


def route(rows: DataFrame, may_use_model: Column) -> DataFrame:
    """CONFIDENT rows are done; the rest goes to a model where rights allow it and to quarantine elsewhere."""
    return rows.withColumn("outcome", F.when(F.col("route") == "CONFIDENT", "DETERMINISTIC").when(may_use_model, "MODEL").otherwise("QUARANTINED"))
