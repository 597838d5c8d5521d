"""Raw rows to canonical articles, with a channel for rejects; rights, scope and work selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions import dates
from plumbline.functions import text as T
from plumbline.functions import url as U
from plumbline.session import shared_folder, ship

#: Sources are a configured dimension; a larger table is joined by a shuffle.
DIMENSION_ROWS = 100_000
#: Rows that one task numbers, and ranges of keys at most.
PLACE_ROWS = 50_000
MOST_RANGES = 1_000


def dimension(rows: DataFrame) -> DataFrame:
    """A table sent to all tasks if its checked size is that of a dimension."""
    return F.broadcast(rows) if rows.count() <= DIMENSION_ROWS else rows


def distinct_or_fail(rows: DataFrame, *keys: str) -> DataFrame:
    """rows, or an error that names a repeated key."""
    again = rows.groupBy(*keys).count().filter("count > 1").first()
    if again is not None:
        raise ValueError(f"repeated key {again.asDict()}")
    return rows


def normalize(raw: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, rejects).  sources (source_id, market, language) is a dimension.

    raw: source_id, source_item_id, url, title, description, published_at_raw, language_hint,
    retrieved_at, seq.  Rejects carry the first field that fails and why.  An unknown publication
    time stays null.  Names of raw's other columns are kept in neither.
    """
    ship(raw.sparkSession)
    dim = dimension(sources.select(F.col("source_id").alias("_source"), F.col("market").alias("_market"), F.col("language").alias("_language")))
    r = raw.join(dim, F.col("source_id") == F.col("_source"), "left").withColumns({
        "canonical_url": U.canonicalize(F.col("url")),
        "_title": T.visible_text("title"),
        "_description": T.visible_text("description"),
        "_item": T.stripped("source_item_id"),
        "_hint": T.stripped("language_hint"),
    })
    no = lambda field, why: F.struct(F.lit(field).alias("field"), F.lit(why).alias("reason"))
    bad = F.when(F.col("_source").isNull(), no("source_id", "unknown source")).when(F.col("canonical_url").isNull(), no("url", "not an absolute http(s) URL")).when(F.col("_title").isNull(), no("title", "missing or empty"))
    r = r.withColumn("_bad", bad)
    identity = F.when(F.col("_item").isNotNull(), T.json_hash(F.lit("v1"), F.lit("source_item_id"), F.col("source_id"), F.col("_item")))
    identity = identity.otherwise(T.json_hash(F.lit("v1"), F.lit("canonical_url"), F.col("source_id"), F.col("canonical_url")))
    articles = r.filter("_bad is null").select(
        "seq", identity.alias("article_id"), "source_id", F.col("_item").alias("source_item_id"), "url", "canonical_url",
        F.col("_title").alias("title"), F.col("_description").alias("description"), F.coalesce("_hint", "_language").alias("language"), F.col("_market").alias("market"),
        dates.published_at(F.col("published_at_raw"), F.col("source_id")).alias("published_at"), F.col("retrieved_at").alias("discovered_at"),
        T.json_hash(F.lit("v1"), F.col("_title"), F.col("_description")).alias("content_hash"),
    )
    return articles, r.filter("_bad is not null").select("seq", "source_id", "url", "_bad.field", "_bad.reason")


def first_of_each(rows: DataFrame, n: int, key: str = "source_id", seq: str = "seq") -> DataFrame:
    """The first n rows of each key in order of arrival; Catalyst cuts each task's rows to n before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(seq))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def counters(fetched: DataFrame, selected: DataFrame, articles: DataFrame, rejects: DataFrame, duplicates: DataFrame, storing: DataFrame) -> DataFrame:
    """Per source: fetched, selected, normalized, rejected (selected = normalized + rejected), duplicate, persisted and storage_skipped.

    storing (source_id) names the sources whose metadata may be kept; articles of others are skipped by storage.
    """
    kept = dimension(storing.select(F.col("source_id").alias("_storing")).distinct())
    stored = articles.join(kept, F.col("source_id") == F.col("_storing"), "left").select("source_id", F.col("_storing").isNotNull().alias("_stored"))
    parts = {"fetched": fetched, "selected": selected, "normalized": articles, "rejected": rejects, "duplicate": duplicates, "persisted": stored.filter("_stored"), "storage_skipped": stored.filter("not _stored")}
    tagged = [f.groupBy("source_id").count().select("source_id", F.lit(name).alias("what"), "count") for name, f in parts.items()]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy("source_id").agg(*[F.coalesce(F.sum(F.when(F.col("what") == name, F.col("count"))), F.lit(0)).alias(name) for name in parts])


# Rights: four predicates that must not be mixed up. ----------------------------------------------
def may_fetch() -> Column:
    return F.col("can_fetch")


def may_store() -> Column:
    return F.col("can_store_metadata")


def may_use_model() -> Column:
    return (F.col("rights_review_status") == "APPROVED") & F.col("can_ai_process")


def may_admit() -> Column:
    """Of a discovered page; the review status plays no part."""
    return F.col("can_fetch") & F.col("can_store_metadata")


def eligible(sources: DataFrame, version: str, rules_version: str = "classification-v2") -> DataFrame:
    """Sources that a classifier version may read: rules need the right to store, any other version the right to use a model."""
    return sources.filter(may_store() if version == rules_version else may_use_model())


def select_sources(sources: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Sources by falling priority and rising id; an unknown id is an error."""
    if wanted is not None:
        known = {r["source_id"] for r in sources.filter(F.col("source_id").isin(wanted)).select("source_id").collect()}  # no more than were asked for
        if set(wanted) - known:
            raise ValueError(f"unknown sources {sorted(set(wanted) - known)}")
        sources = sources.filter(F.col("source_id").isin(wanted))
    return sources.orderBy(F.desc("priority"), F.asc("source_id"))


def flatten_state(config: DataFrame, state: DataFrame) -> DataFrame:
    """Configured sources with their health, UNKNOWN where none is known."""
    s = state.select(F.col("source_id").alias("_id"), "health_status")
    return config.join(s, F.col("source_id") == F.col("_id"), "left").select(*config.columns, F.coalesce("health_status", F.lit("UNKNOWN")).alias("health_status"))


# Work selection ----------------------------------------------------------------------------------
def scope(rows: DataFrame, *, sources: list[str] | None = None, articles: list[str] | None = None, since=None, before=None) -> DataFrame:
    """Articles of these sources and ids, discovered from since on and before before; every test is pushed to the scan."""
    if sources is not None:
        rows = rows.filter(F.col("source_id").isin(sources))
    if articles is not None:
        rows = rows.filter(F.col("article_id").isin(articles))
    if since is not None:
        rows = rows.filter(F.col("discovered_at") >= F.lit(since))
    return rows if before is None else rows.filter(F.col("discovered_at") < F.lit(before))


def unclassified(articles: DataFrame, classifications: DataFrame, version: str, limit: int) -> DataFrame:
    """The oldest articles without a row of this version."""
    done = classifications.filter(F.col("classifier_version") == version).select("article_id")
    return articles.join(done, "article_id", "left_anti").orderBy("discovered_at", "article_id").limit(limit)


LINEAGE = ("requested_model", "prompt_version", "taxonomy_version")


def lineage_mismatch(classifications: DataFrame, version: str, want: dict[str, str]) -> DataFrame:
    """The first row (by article) of the version whose lineage differs, if there is one."""
    differs = F.lit(False)
    for c in LINEAGE:
        differs |= ~F.col(c).eqNullSafe(F.lit(want[c]))
    return classifications.filter((F.col("classifier_version") == version) & differs).orderBy("article_id").limit(1)


def matching_work(articles: DataFrame, classifications: DataFrame, version: str, cutoff, fresh_since) -> DataFrame:
    """Articles classified by the version up to cutoff and discovered or published since fresh_since; a null time isn't fresh."""
    c = classifications.filter((F.col("status") == "SUCCEEDED") & (F.col("classifier_version") == version) & (F.col("classified_at") <= F.lit(cutoff)))
    fresh = (F.col("discovered_at") >= F.lit(fresh_since)) | F.coalesce(F.col("published_at") >= F.lit(fresh_since), F.lit(False))
    return articles.filter(fresh).join(c.drop("source_id"), "article_id")


def page(rows: DataFrame, key: str, after, limit: int) -> DataFrame:
    """The next rows by key, 1 to 1000 of them, after a cursor (null: from the start)."""
    if isinstance(limit, bool) or not 1 <= limit <= 1000:
        raise ValueError("a page holds 1 to 1000 rows")
    return (rows if after is None else rows.filter(F.col(key) > F.lit(after))).orderBy(key).limit(limit)


def all_pages(rows: DataFrame, key: str, limit: int, most: int | None = None) -> DataFrame:
    """Every row by key, in pages: page (from 0) and place.  A key that repeats and so doesn't advance is an error, and so are more than most rows, where a run sets such a bound.

    More than PLACE_ROWS rows are dealt into ranges of keys, which are counted; rows are numbered within their range only.
    """
    page(rows, key, None, limit)  # checks the limit
    n = rows.count()
    if most is not None and n > most:
        raise ValueError(f"a snapshot of {n} rows exceeds {most}")
    distinct_or_fail(rows, key)
    if n <= PLACE_ROWS:
        placed = rows.withColumn("place", (F.row_number().over(Window.orderBy(key)) - 1).cast("long"))
    else:
        shared_folder(rows.sparkSession)
        parts = min(MOST_RANGES, -(-n // PLACE_ROWS))
        ranged = rows.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()).checkpoint()  # else the ranges could differ from those that are counted
        counts = ranged.groupBy(F.col("_range").alias("_r")).agg(F.count("*").alias("_c"))  # MOST_RANGES rows at most
        before = counts.select("_r", (F.sum("_c").over(Window.orderBy("_r")) - F.col("_c")).alias("_before"))
        within = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
        placed = ranged.withColumn("_within", within).join(F.broadcast(before), F.col("_range") == F.col("_r")).withColumn("place", F.col("_before") + F.col("_within")).drop("_range", "_r", "_before", "_within")
    return placed.withColumn("page", F.floor(F.col("place") / limit))


def model_input(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """article_id and what a model may see of it: seven fields without ids or addresses, domains in order.  An article without its source is an error."""
    dim = dimension(sources.select(F.col("source_id").alias("_source"), F.array_sort("domains").alias("source_domains"), "source_type", "authority_level"))
    rows = articles.join(dim, F.col("source_id") == F.col("_source"), "left")
    missing = F.when(F.col("_source").isNull(), F.raise_error(F.concat(F.lit("unknown source "), F.col("source_id"))))
    seen = F.struct("title", "description", F.col("market").alias("source_market"), F.col("language").alias("source_language"), "source_domains", "source_type", "authority_level")
    return rows.select("article_id", missing.otherwise(seen).alias("input"))


def published(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Only the columns of a contract, in its order; what a store adds of its own stays inside."""
    return rows.select(*columns)


def lookup(rows: DataFrame, **key) -> DataFrame:
    """The row with this key, if there is one."""
    for name, value in key.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    return rows.limit(1)
