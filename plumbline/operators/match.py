"""Matching classified articles with user preferences.

The Cartesian product is never made: preferences and labels are exploded to (dimension, value) rows
and meet by equality.  A pair that shares several values is kept once, at the least of them, so no
pairs are gathered again.  Users with equal preferences are matched as one and come apart at the end;
more users than a dimension has are matched in blocks, to which articles are moved, not pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.normalize import DIMENSION_ROWS

MARKET_ORDER = ("VN", "US", "EU", "CN")
FRESH = 24 * 3600
BREAKING = 2 * 3600


#: Parts into which the rows of one value are dealt where neither side can be broadcast.
SALTS = 16
#: Users of one set of preferences that one row holds, and users of a block of such rows.
TEAM = 1_000
BLOCK = 100_000


def _meet(left: DataFrame, right: DataFrame, key: str, other: str, spread: str) -> DataFrame:
    """left and right where key = other: right is broadcast if its checked size is that of a dimension, else left's rows of a key are dealt to SALTS parts.

    Spark may not choose to broadcast right, as its estimate leaves out the copies for the parts.
    """
    if right.count() <= DIMENSION_ROWS:
        return left.join(F.broadcast(right), F.col(key) == F.col(other))
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right.hint("merge"), (F.col(key) == F.col(other)) & (F.col("_salt") == F.col("_part"))).drop("_salt", "_part")


def _teams(users: DataFrame, blocks: int) -> DataFrame:
    """users (user_id, p, set_id) in teams of about TEAM that share their preferences p: p, team_users, block."""
    sizes = users.groupBy(F.col("set_id").alias("u_set")).agg(F.first("p").alias("p"), F.ceil(F.count("*") / TEAM).cast("long").alias("n"))
    counted = users.select("user_id", "set_id").join(sizes, F.col("set_id") == F.col("u_set")).withColumn("team", F.pmod(F.xxhash64("user_id"), F.col("n")))
    teams = counted.groupBy("set_id", "team").agg(F.first("p").alias("p"), F.collect_list("user_id").alias("team_users"))
    return teams.select("p", "team_users", F.pmod(F.xxhash64("set_id", "team"), F.lit(blocks)).alias("block"))


def _meet_teams(left: DataFrame, teams: DataFrame, blocks: int) -> DataFrame:
    """left and teams where value = wanted: left's rows go to each block, so what is moved are rows for blocks of users, never the pairs.

    The number of partitions is fixed, as the size of what is moved says nothing of the pairs that it makes.
    """
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    n = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks * SALTS)
    left = left.withColumn("_block", each(blocks)).withColumn("_salt", F.pmod(F.xxhash64("article_id"), F.lit(SALTS))).repartition(n, "_block", "_salt", "value")
    teams = teams.withColumn("_part", each(SALTS)).repartition(n, "block", "_part", "wanted")
    return left.join(teams.hint("shuffle_hash"), (F.col("_block") == F.col("block")) & (F.col("_salt") == F.col("_part")) & (F.col("value") == F.col("wanted")))


def _values(markets, categories, topics):
    named = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(kind + ":"), x))
    return F.array_distinct(F.concat(named("market", markets), named("category", categories), named("topic", topics)))


def match(work: DataFrame, prefs: DataFrame) -> DataFrame:
    """Candidates (user_id, article_id, reasons, importance, score, breaking, candidate_id).

    work: article_id, source_id, markets, category, topics, confidence, published_at, discovered_at,
    matched_at (times in seconds) and, if they are there, classified_at and is_relevant.  prefs: user_id,
    markets, categories, topics, muted_source_ids, muted_topics, breaking_alert_enabled.  A match before
    the article was discovered or classified is an error; irrelevant articles match nobody.
    """
    early = F.when(F.col("matched_at") < F.col("discovered_at"), F.raise_error(F.lit("matched_at lies before discovered_at")))
    if "classified_at" in work.columns:
        early = early.when(F.col("matched_at") < F.col("classified_at"), F.raise_error(F.lit("matched_at lies before classified_at")))
    work = work.withColumn("matched_at", early.otherwise(F.col("matched_at")))
    if "is_relevant" in work.columns:
        work = work.filter("is_relevant")
    effective = F.when(F.col("published_at") <= F.col("matched_at"), F.col("published_at")).otherwise(F.col("discovered_at"))
    fresh = work.filter(F.col("matched_at") - effective <= FRESH)
    a = fresh.select("article_id", "source_id", "topics", "confidence", "matched_at", "discovered_at", _values(F.col("markets"), F.array_compact(F.array("category")), F.col("topics")).alias("labels"))
    a = a.select("*", F.explode("labels").alias("value"))

    kinds = ["markets", "categories", "topics", "muted_source_ids", "muted_topics"]
    same = F.struct(*[F.array_sort(F.array_distinct(c)).alias(c) for c in kinds], "breaking_alert_enabled")
    users = prefs.select(F.col("user_id"), same.alias("p")).withColumn("set_id", F.sha2(F.to_json("p"), 256))
    n_users = users.count()
    few, blocks = n_users <= DIMENSION_ROWS, -(-n_users // BLOCK)
    sets, own = (users.groupBy("set_id").agg(F.first("p").alias("p")), ["set_id"]) if few else (_teams(users, blocks), ["team_users", "block"])
    sets = sets.select(*own, "p.muted_source_ids", F.col("p.muted_topics").alias("muted_topics"), "p.breaking_alert_enabled", sum((F.size(f"p.{c}") > 0).cast("int") for c in kinds[:3]).alias("active"), _values(F.col("p.markets"), F.col("p.categories"), F.col("p.topics")).alias("wants"))
    sets = sets.select("*", F.explode("wants").alias("wanted"))

    pairs = (_meet(a, sets, "value", "wanted", "article_id") if few else _meet_teams(a, sets, blocks)).withColumn("hit", F.array_intersect("labels", "wants"))
    pairs = pairs.filter((F.col("value") == F.array_min("hit")) & ~F.array_contains("muted_source_ids", F.col("source_id")) & ~F.arrays_overlap("muted_topics", "topics"))
    dims = F.size(F.array_distinct(F.transform("hit", lambda x: F.element_at(F.split(x, ":"), 1))))
    raw = F.col("confidence") * (dims / F.col("active"))
    rank = F.array(*[F.lit(f"market:{m}") for m in MARKET_ORDER])
    reasons = F.concat(F.filter(rank, lambda m: F.array_contains("hit", m)), F.array_sort(F.filter("hit", lambda x: x.startswith("category:"))), F.array_sort(F.filter("hit", lambda x: x.startswith("topic:"))))
    high = (dims >= 2) & (raw >= 0.90)  # before rounding
    age = F.col("matched_at") - F.col("discovered_at")
    pairs = pairs.select(
        own[0], "article_id", reasons.alias("reasons"), F.when(high, "HIGH").otherwise("NORMAL").alias("importance"), F.round(raw, 6).alias("score"),
        (F.col("breaking_alert_enabled") & high & age.between(0, BREAKING)).alias("breaking"),
    )
    found = pairs.join(F.broadcast(users.select("user_id", "set_id")), "set_id") if few else pairs.withColumn("user_id", F.explode("team_users"))
    return found.select("user_id", "article_id", "reasons", "importance", "score", "breaking", F.sha2(F.to_json(F.array(F.lit("alert-candidate-v1"), F.col("user_id"), F.col("article_id"))), 256).alias("candidate_id"))


def first_write_wins(new: DataFrame, stored: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The rows of new that a first-write-wins sink would add: the first of each key that isn't stored."""
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*new.columns), seq).alias("r")).select("r.*")
    return first.join(stored.select(*keys), keys, "left_anti")


def record_candidates(new: DataFrame, stored: DataFrame) -> DataFrame:
    """new (candidate_id, user_id, article_id, seq from 0) with outcome: CREATED, or ALREADY_EXISTS where an earlier or a stored row has the pair,
    and first_seq, the row that holds the pair (-1: the stored one).

    A pair under another id, or an id of another pair, is an error.
    """
    key = ["candidate_id", "user_id", "article_id"]
    known = stored.select(*key, F.lit(-1).cast("long").alias("seq")).unionByName(new.select(*key, F.col("seq").cast("long").alias("seq")))
    pairs = known.groupBy(F.col("user_id").alias("_user"), F.col("article_id").alias("_article")).agg(F.min("seq").alias("_first"), F.min("candidate_id").alias("_least"), F.max("candidate_id").alias("_most"))
    ids = known.groupBy(F.col("candidate_id").alias("_id")).agg(F.count_distinct("user_id", "article_id").alias("_pairs"))
    rows = new.join(pairs, (F.col("user_id") == F.col("_user")) & (F.col("article_id") == F.col("_article"))).join(ids, F.col("candidate_id") == F.col("_id"))
    outcome = F.when(F.col("_least") != F.col("_most"), F.raise_error(F.lit("a pair has two candidate ids"))).when(F.col("_pairs") > 1, F.raise_error(F.lit("a candidate id names two pairs")))
    return rows.select(*new.columns, outcome.when(F.col("_first") == F.col("seq"), "CREATED").otherwise("ALREADY_EXISTS").alias("outcome"), F.col("_first").alias("first_seq"))
