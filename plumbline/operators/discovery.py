"""Secondary discovery: routing, admission, daily folds, evidence, capture metrics, tiers, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.url import canonicalize, host_of, path_for_matching

SAMPLES = 3


def resolve(candidates: DataFrame, routes: DataFrame) -> DataFrame:
    """candidates (cand_id, canonical_url) with status, target and how the route proves identity.

    routes (hostname, path_prefix, target_source_id, identity_mode) are a small dimension.  A host's routes share few prefixes, so the join is by host and the prefix is a residual filter.
    """
    c = candidates.withColumn("host", host_of(F.col("canonical_url"))).withColumn("path", path_for_matching(F.col("canonical_url")))
    prefix = F.when(F.col("path_prefix").endswith("/"), F.col("path_prefix")).otherwise(F.concat("path_prefix", F.lit("/")))
    hits = c.join(routes, (F.col("host") == F.col("hostname")) & F.col("path").startswith(prefix)).groupBy(F.col("cand_id").alias("h_id")).agg(F.count("*").alias("n"), F.min("target_source_id").alias("target"), F.min("identity_mode").alias("mode"))
    out = c.join(hits, F.col("cand_id") == F.col("h_id"), "left")
    status = F.when(F.col("n").isNull(), "UNKNOWN").when(F.col("n") == 1, "RESOLVED").otherwise("AMBIGUOUS_ROUTE")
    return out.select(*candidates.columns, status.alias("route_status"), *[F.when(F.col("n") == 1, F.col(c)).alias(name) for c, name in (("target", "target_source_id"), ("mode", "identity_mode"))])


def overlapping_routes(routes: DataFrame) -> DataFrame:
    """Pairs of a host's routes of which one covers the other; a catalogue must have none."""
    a, b = routes.alias("a"), routes.alias("b")
    covers = F.col("b.path_prefix").startswith(F.col("a.path_prefix"))
    other = (F.col("a.path_prefix") != F.col("b.path_prefix")) | (F.col("a.target_source_id") < F.col("b.target_source_id"))
    return a.join(b, (F.col("a.hostname") == F.col("b.hostname")) & covers & other).select(F.col("a.hostname").alias("hostname"), F.col("a.path_prefix").alias("outer_prefix"), F.col("b.path_prefix").alias("inner_prefix"))


def admit(resolved: DataFrame, sources: DataFrame) -> DataFrame:
    """resolved with an admission status: the route's, then rights, then identity; ADMITTED if none objects.

    A discovered page carries no id of its publisher, so a route that needs one never admits it.
    """
    s = sources.select(F.col("source_id"), (F.col("can_fetch") & F.col("can_store_metadata")).alias("allowed"))
    out = resolved.join(s, F.col("target_source_id") == F.col("source_id"), "left")
    lost = F.col("target_source_id").isNotNull() & F.col("source_id").isNull()
    status = F.when(lost, F.raise_error(F.concat(F.lit("a route leads to an unknown source "), F.col("target_source_id")))).when(F.col("route_status") != "RESOLVED", F.col("route_status"))
    status = status.when(~F.coalesce("allowed", F.lit(False)), "RIGHTS_METADATA_DENIED").when(F.col("identity_mode") == "NATIVE_SOURCE_ITEM_ID_REQUIRED", "IDENTITY_INCOMPATIBLE").otherwise("ADMITTED")
    return out.select(*resolved.columns, status.alias("admission"))


def unknown_rate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The share of sightings whose publisher no route knows."""
    return rows.groupBy(*keys).agg(F.coalesce(F.avg((F.col("admission") == "UNKNOWN").cast("double")), F.lit(0.0)).alias("unknown_rate"))


# What a tier means for discovery and for fetching directly, by how a route proves identity.
POLICY = {
    "INSUFFICIENT_DATA": {"CANONICAL_URL_FALLBACK": ("NO_CHANGE", "UNCHANGED"), "NATIVE_SOURCE_ITEM_ID_REQUIRED": ("NO_CHANGE", "UNCHANGED")},
    "GREEN_A": {"CANONICAL_URL_FALLBACK": ("PRIMARY", "MAY_REDUCE_TO_SENTINEL"), "NATIVE_SOURCE_ITEM_ID_REQUIRED": ("DISCOVERY_ACCELERATOR", "REQUIRED")},
    "GREEN_B": {"CANONICAL_URL_FALLBACK": ("PRIMARY", "MAY_REDUCE_TO_SENTINEL"), "NATIVE_SOURCE_ITEM_ID_REQUIRED": ("DISCOVERY_ACCELERATOR", "REQUIRED")},
    "YELLOW": {"CANONICAL_URL_FALLBACK": ("PARALLEL_DISCOVERY", "REQUIRED"), "NATIVE_SOURCE_ITEM_ID_REQUIRED": ("PARALLEL_DISCOVERY", "REQUIRED")},
    "RED": {"CANONICAL_URL_FALLBACK": ("SUPPLEMENTAL", "REQUIRED_PRIMARY"), "NATIVE_SOURCE_ITEM_ID_REQUIRED": ("SUPPLEMENTAL", "REQUIRED_PRIMARY")},
}


def policy(tier_: Column, identity_mode: Column) -> Column:
    """struct(role, direct_path) of a tier and a mode; null for values outside the vocabulary."""
    return F.coalesce(*[F.when((tier_ == t) & (identity_mode == m), F.struct(F.lit(role).alias("role"), F.lit(path).alias("direct_path"))) for t, modes in POLICY.items() for m, (role, path) in modes.items()])


def utc_second(at: Column) -> Column:
    """A time at whole seconds; a time without a zone (timestamp_ntz) isn't one and fails to cast."""
    return F.date_trunc("second", at)


def lookback(rows: DataFrame, at: str, end, minutes: int, start=None) -> DataFrame:
    """Rows of [start, end) at whole seconds; without a start, minutes back from the end."""
    stop = utc_second(F.lit(end).cast("timestamp"))
    begin = utc_second(F.lit(start).cast("timestamp")) if start is not None else stop - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    checked = F.when(begin >= stop, F.raise_error(F.lit("a window must start before it ends"))).otherwise(begin)
    return rows.filter((F.col(at) >= checked) & (F.col(at) < stop))


def sample_of(url: Column) -> Column:
    """struct(url, hostname) of a sighting, or null where its URL isn't canonical; nothing else is kept of it."""
    c = canonicalize(url)
    return F.when(c.isNotNull() & (F.coalesce(host_of(c), F.lit("")) != ""), F.struct(c.alias("url"), host_of(c).alias("hostname")))


def duplicate_rate(rows: DataFrame, keys: list[str], url: str) -> DataFrame:
    """Per key: n and the share of sightings that repeat a URL (in its canonical form, or verbatim where it has none)."""
    seen = rows.withColumn("_url", F.coalesce(canonicalize(F.col(url)), F.col(url)))
    return seen.groupBy(*keys).agg(F.count("*").alias("n"), ((F.count("*") - F.count_distinct("_url")) / F.count("*")).alias("rate"))


def pivot_counts(rows: DataFrame, keys: list[str], column: str, values: dict[str, str]) -> DataFrame:
    """Per key: how many rows have each of the named values."""
    return rows.groupBy(*keys).agg(*[F.count_if(F.col(column) == value).alias(name) for name, value in values.items()])


#: Delays of an item on its way to a reader: from one time to another.
DELAYS = {
    "discovery": ("published_at", "discovered_at"), "classification": ("discovered_at", "classified_at"), "matching": ("classified_at", "matched_at"),
    "queue": ("matched_at", "queued_at"), "delivery": ("queued_at", "sent_at"), "end_to_end": ("published_at", "sent_at"),
}


def latencies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the six delays in seconds; null where either time is unknown."""
    return rows.select(*keys, *[(F.col(b) - F.col(a)).alias(f"{name}_latency") for name, (a, b) in DELAYS.items()])


def fold_daily(sightings: DataFrame, keys: list[str], at: str, seq: str, sample: Column) -> DataFrame:
    """Per UTC day and key: count, first and last time, the first samples in order of arrival.

    One window ranks the samples, and one aggregate takes all; no list holds more than SAMPLES.
    """
    s = sightings.select(F.to_date(F.col(at)).alias("observation_day"), *keys, F.col(at).alias("_at"), F.col(seq).alias("_seq"), sample.alias("_sample"))
    rank = F.row_number().over(Window.partitionBy("observation_day", *keys).orderBy(F.col("_sample").isNull(), "_seq"))
    few = F.when(F.col("_sample").isNotNull() & (F.col("_rank") <= SAMPLES), F.struct("_rank", "_sample"))
    g = s.withColumn("_rank", rank).groupBy("observation_day", *keys).agg(F.count("*").alias("observation_count"), F.min("_at").alias("first_seen_at"), F.max("_at").alias("last_seen_at"), F.array_sort(F.collect_list(few)).alias("_few"))
    return g.select("observation_day", *keys, "observation_count", "first_seen_at", "last_seen_at", F.transform("_few", lambda x: x["_sample"]).alias("samples"))


def merge_folds(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Two folds as one; a is the earlier, its samples come first."""
    both = a.withColumn("_o", F.lit(0)).unionByName(b.withColumn("_o", F.lit(1)))
    g = both.groupBy("observation_day", *keys).agg(F.sum("observation_count").alias("observation_count"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), F.array_sort(F.collect_list(F.struct("_o", "samples"))).alias("_s"))
    return g.withColumn("samples", F.slice(F.flatten(F.transform("_s", lambda x: x["samples"])), 1, SAMPLES)).drop("_s")


def fold_evidence(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Per key: the first known published_at, the earliest direct and discovered times."""
    first = F.min_by(F.col("published_at"), F.when(F.col("published_at").isNotNull(), F.col(seq)))
    return rows.groupBy(*keys).agg(first.alias("published_at"), F.min("direct_at").alias("direct_at"), F.min("seen_at").alias("seen_at"))


def capture(rows: DataFrame, keys: list[str], windows: dict[str, int]) -> DataFrame:
    """Per key: sample size, capture rates by window (seconds), misses after the last window, nearest-rank delays."""
    eligible = F.col("published_at").isNotNull()
    delay = F.col("seen_at") - F.col("published_at")
    usable = F.col("admitted") & F.col("seen_at").isNotNull()
    last = max(windows.values())
    rates = [F.coalesce(F.avg(F.when(eligible, F.when(usable & (delay <= w), 1.0).otherwise(0.0))), F.lit(0.0)).alias(f"rate_{name}") for name, w in windows.items()]
    missed = F.count_if(eligible & ~F.coalesce(usable & (delay <= last), F.lit(False))).alias("missed")
    d = F.when(eligible & usable, delay)
    ranks = [F.expr(f"percentile_disc({p}) within group (order by _delay)").cast("double").alias(f"p{round(100 * p)}") for p in (0.5, 0.95)]
    return rows.withColumn("_delay", d).groupBy(*keys).agg(F.count_if(eligible).alias("n"), *rates, missed, *ranks)


def tier(days: Column, n: Column, fast: Column, slow: Column) -> Column:
    """The tier of a query from its days, sample and capture rates within an hour and a day."""
    return F.when((days < 14) | (n < 50), "INSUFFICIENT_DATA").when((fast >= 0.90) & (slow >= 0.97), "GREEN_A").when((fast >= 0.85) & (slow >= 0.95), "GREEN_B").when((fast >= 0.75) & (slow >= 0.90), "YELLOW").otherwise("RED")


def prune(folds: DataFrame, oldest_day: str, oldest_sample_day: str) -> DataFrame:
    """Days before oldest_day go; samples before oldest_sample_day are emptied.  The cutoffs themselves stay."""
    kept = folds.filter(F.col("observation_day") >= F.lit(oldest_day).cast("date"))
    return kept.withColumn("samples", F.when(F.col("observation_day") < F.lit(oldest_sample_day).cast("date"), F.expr("cast(array() as array<string>)")).otherwise(F.col("samples")))


def prune_counts(folds: DataFrame, evidence: DataFrame, oldest_day: str, oldest_sample_day: str, oldest_evidence_day: str) -> DataFrame:
    """What a retention run does: fold rows deleted, rows whose samples are cleared, evidence rows deleted."""
    day = lambda d: F.lit(d).cast("date")
    gone = F.col("observation_day") < day(oldest_day)
    cleared = ~gone & (F.col("observation_day") < day(oldest_sample_day)) & (F.size("samples") > 0)
    one = folds.agg(F.count_if(gone).alias("deleted_observations"), F.count_if(cleared).alias("cleared_samples"))
    two = evidence.agg(F.count_if(F.col("evidence_day") < day(oldest_evidence_day)).alias("deleted_evidence"))
    names = [*one.columns, *two.columns]
    return one.unionByName(two, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in names])
