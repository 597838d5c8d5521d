"""The classification queue as pure transitions, and the price of usage at its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.normalize import LINEAGE


def claim(state: DataFrame, now, k: int, lease: int, run: str) -> DataFrame:
    """The k rows to claim next: due retries and expired leases, by due time, creation and id; exhausted ones are quarantined.

    outcome is CLAIMED or RECOVERED_QUARANTINED.  A claim's token follows from the run's name, the row and
    the attempt, so a claim that is worked out again has the same one.
    """
    if not 30 <= lease <= 900:
        raise ValueError("a lease lasts 30 to 900 seconds")
    if not run:
        raise ValueError("a run needs a name")
    due = F.when(F.col("status") == "RETRYABLE", F.col("next_attempt_at")).when(F.col("status") == "PROCESSING", F.col("lease_expires_at"))
    ready = state.withColumn("due", due).filter(F.col("due") <= now).orderBy("due", "created_at", "article_id").limit(k)
    spent = (F.col("status") == "PROCESSING") & (F.col("attempt_count") >= F.col("max_attempts"))
    attempt = (F.col("attempt_count") + F.when(spent, 0).otherwise(1)).cast("long")
    token = F.sha2(F.concat_ws(":", F.lit(run), F.col("article_id").cast("string"), attempt.cast("string")), 256)
    return ready.select(
        "article_id", F.when(spent, "RECOVERED_QUARANTINED").otherwise("CLAIMED").alias("outcome"), F.when(spent, "QUARANTINED").otherwise("PROCESSING").alias("status"), attempt.alias("attempt_count"),
        F.when(~spent, token).alias("claim_token"), F.when(~spent, F.lit(now) + lease).alias("lease_expires_at"), F.when(spent, "lease_expired_attempt_budget_exhausted").alias("error"),
    )


# Outcomes of an enqueue, transitions and usage.
OUTCOME_OF = {"RETRYABLE": "EXISTING_RETRYABLE", "PROCESSING": "EXISTING_PROCESSING", "SUCCEEDED": "ALREADY_SUCCEEDED", "QUARANTINED": "QUARANTINED"}
#: Where a row may go from a status that isn't terminal.
EDGES = {"RETRYABLE": ("PROCESSING", "QUARANTINED"), "PROCESSING": ("PROCESSING", "RETRYABLE", "SUCCEEDED", "QUARANTINED")}
USAGE = ("prompt_tokens", "prompt_cache_hit_tokens", "prompt_cache_miss_tokens", "completion_tokens", "total_tokens", "estimated_cost_usd")
KEY = ("article_id", "classifier_version")

# Failure categories by what they mean for the item and for the run.
QUARANTINE = ("RIGHTS_DENIED", "AI_FALLBACK_NOT_ALLOWED", "INVALID_INPUT", "CONTENT_FILTER", "OUTPUT_TRUNCATED", "UNEXPECTED_TOOL_CALL")
RETRY_ITEM = ("EMPTY_CONTENT", "INVALID_OUTPUT")
SYSTEMIC = ("CONFIGURATION", "TIMEOUT", "CONNECTION", "RATE_LIMIT", "PROVIDER_HTTP", "MALFORMED_RESPONSE", "INVALID_USAGE", "INSUFFICIENT_SYSTEM_RESOURCE")


def _beside(commands: DataFrame, state: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Commands with the stored columns of their key as _name, null where the key isn't stored."""
    s = state.select(*[F.col(c).alias(f"_{c}") for c in (*KEY, *columns)])
    return commands.join(s, (F.col("article_id") == F.col("_article_id")) & (F.col("classifier_version") == F.col("_classifier_version")), "left")


def enqueue(commands: DataFrame, state: DataFrame) -> DataFrame:
    """commands (key and lineage; one row a key) with outcome and the lineage columns that differ from the stored row's.

    CREATED rows are to be added as RETRYABLE with no attempt; see created.
    """
    c = _beside(commands, state, (*LINEAGE, "status"))
    differs = F.array_compact(F.array(*[F.when(~F.col(k).eqNullSafe(F.col(f"_{k}")), k) for k in LINEAGE]))
    known = F.coalesce(*[F.when(F.col("_status") == s, o) for s, o in OUTCOME_OF.items()])
    outcome = F.when(F.col("_article_id").isNull(), "CREATED").when(F.size(differs) > 0, "LINEAGE_MISMATCH").otherwise(known)
    return c.select(*commands.columns, outcome.alias("outcome"), F.when(outcome == "LINEAGE_MISMATCH", differs).otherwise(F.expr("cast(array() as array<string>)")).alias("mismatched_fields"))


def created(enqueued: DataFrame, now, max_attempts: int = 3) -> DataFrame:
    """The rows that an enqueue adds."""
    if not 1 <= max_attempts <= 12:
        raise ValueError("max_attempts is 1 to 12")
    new = {"status": F.lit("RETRYABLE"), "attempt_count": F.lit(0), "max_attempts": F.lit(max_attempts), "next_attempt_at": F.lit(now), "created_at": F.lit(now)}
    return enqueued.filter("outcome = 'CREATED'").drop("outcome", "mismatched_fields").withColumns(new)


def _holds(now) -> Column:
    """Whether a command's token still holds the stored row."""
    return F.coalesce((F.col("_status") == "PROCESSING") & (F.col("_claim_token") == F.col("claim_token")) & (F.col("_lease_expires_at") > F.lit(now)), F.lit(False))


_LEASE = ("status", "claim_token", "lease_expires_at")


def renew(commands: DataFrame, state: DataFrame, now, lease: int = 300) -> DataFrame:
    """commands (key, claim_token) with RENEWED and the new end of the lease, or LOST_CLAIM."""
    if not 30 <= lease <= 900:
        raise ValueError("a lease lasts 30 to 900 seconds")
    c = _beside(commands, state, _LEASE)
    return c.select(*commands.columns, F.when(_holds(now), "RENEWED").otherwise("LOST_CLAIM").alias("outcome"), F.when(_holds(now), F.lit(now) + lease).alias("lease_expires_at"))


def usage_problem() -> Column:
    """Why a completion's usage can't be right, or null."""
    n = {c: F.col(c) for c in USAGE}
    negative = F.least(*[v.cast("double") for v in n.values()]) < 0
    sums = (n["prompt_tokens"] != n["prompt_cache_hit_tokens"] + n["prompt_cache_miss_tokens"]) | (n["total_tokens"] != n["prompt_tokens"] + n["completion_tokens"])
    free = F.greatest(*[v.cast("double") for v in n.values()]) != 0
    rules = F.col("method") == "DETERMINISTIC"
    return F.when(negative | sums, "invalid usage").when(rules & (free | (F.col("provider_attempts") != 0)), "rules use no provider").when(~rules & ~F.coalesce(F.col("provider_attempts").between(1, 3), F.lit(False)), "a provider takes 1 to 3 attempts")


def complete(commands: DataFrame, state: DataFrame, now) -> DataFrame:
    """commands (key, claim_token, method, provider_attempts, usage) with outcome and the usage added to the stored row's.

    A replay finds ALREADY_SUCCEEDED, a lost or expired claim LOST_CLAIM; neither adds usage.
    """
    c = _beside(commands, state, (*_LEASE, *USAGE))
    outcome = F.when(usage_problem().isNotNull(), F.raise_error(usage_problem())).when(_holds(now), "SUCCEEDED").when(F.col("_status") == "SUCCEEDED", "ALREADY_SUCCEEDED").otherwise("LOST_CLAIM")
    total = [F.when(F.col("outcome") == "SUCCEEDED", F.coalesce(F.col(f"_{k}"), F.lit(0)) + F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in USAGE]
    return c.withColumn("outcome", outcome).select(*[k for k in commands.columns if k not in USAGE], "outcome", *total)


def illegal_transitions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that changed as they mustn't: new rows that aren't RETRYABLE with no attempt, terminal rows that changed or went, edges that don't exist."""
    b, a = before.select(*KEY, F.struct(*before.columns).alias("b")), after.select(*KEY, F.struct(*before.columns).alias("a"))
    both = b.join(a, list(KEY), "full_outer")
    was, now = F.col("b.status"), F.col("a.status")
    edge = F.coalesce(*[F.when(was == s, now.isin(*to) | now.eqNullSafe(was) & F.col("a").eqNullSafe(F.col("b"))) for s, to in EDGES.items()])
    why = F.when(F.col("b").isNull() & ((now != "RETRYABLE") | (F.col("a.attempt_count") != 0)), "a row starts RETRYABLE without attempts")
    why = why.when(was.isin("SUCCEEDED", "QUARANTINED") & ~F.col("a").eqNullSafe(F.col("b")), "a terminal row is final").when(F.col("b").isNotNull() & F.col("a").isNotNull() & ~edge, F.concat(was, F.lit(" to "), now))
    return both.withColumn("why", why).filter("why is not null").select(*KEY, "why")


def disposition(category: Column, retryable: Column, attempt_count: Column) -> Column:
    """What a failure means: struct of disposition, whether the row may be tried again, and why the run stops (or null)."""
    later = F.when(attempt_count <= 1, "RETRY_15_MINUTES").otherwise("RETRY_60_MINUTES")
    systemic = F.when((category == "RATE_LIMIT") | ~retryable, "RETRY_60_MINUTES").otherwise(later)
    what = F.when(category.isin(*QUARANTINE), "QUARANTINE").when(category.isin(*RETRY_ITEM), later).when(category.isin(*SYSTEMIC), systemic).when(retryable, later).otherwise("QUARANTINE")
    again = F.when(category.isin(*RETRY_ITEM, *SYSTEMIC), True).otherwise(retryable)
    item = category.isin(*QUARANTINE, *RETRY_ITEM)
    stop = F.when(category == "CONFIGURATION", "CONFIGURATION").when(~item & (category.isin(*SYSTEMIC) | retryable), "SYSTEMIC_PROVIDER")
    return F.struct(what.alias("disposition"), again.alias("retryable"), stop.alias("stop_reason"))


def _failure_problem() -> Column:
    """Why a failure can't be recorded as it is told, or null."""
    n = {c: F.col(c) for c in USAGE}
    negative = F.least(*[v.cast("double") for v in n.values()]) < 0
    sums = (n["prompt_tokens"] != n["prompt_cache_hit_tokens"] + n["prompt_cache_miss_tokens"]) | (n["total_tokens"] != n["prompt_tokens"] + n["completion_tokens"])
    why = F.when(~F.coalesce(F.col("provider_attempts").between(0, 3), F.lit(False)), "failed provider attempts are 0 to 3")
    why = why.when(~F.coalesce(F.col("disposition").isin("RETRY_15_MINUTES", "RETRY_60_MINUTES", "QUARANTINE"), F.lit(False)), "no such disposition")
    why = why.when(F.coalesce(F.length("category"), F.lit(0)) == 0, "a failure needs a category").when(F.col("retryable").isNull(), "a failure is retryable or not")
    return why.when(~F.coalesce(F.col("http_status"), F.lit(100)).between(100, 599), "no such HTTP status").when(F.coalesce(negative | sums, F.lit(False)), "invalid usage")


def fail(commands: DataFrame, state: DataFrame, now) -> DataFrame:
    """commands (key, claim_token, category, http_status, retryable, disposition, provider_attempts, usage) after a failed attempt.

    The holder of the claim gets RETRY_SCHEDULED or QUARANTINED, the error that is kept, when to try again
    and the usage added to the stored row's; any other gets LOST_CLAIM and adds nothing.
    """
    c = _beside(commands, state, (*_LEASE, "attempt_count", "max_attempts", *USAGE))
    spent = F.col("_attempt_count") >= F.col("_max_attempts")
    refused = ~F.col("retryable") | (F.col("disposition") == "QUARANTINE")
    wrong = _failure_problem()
    c = c.withColumn("outcome", F.when(wrong.isNotNull(), F.raise_error(wrong)).when(~_holds(now), "LOST_CLAIM").when(refused | spent, "QUARANTINED").otherwise("RETRY_SCHEDULED"))
    held = F.col("outcome") != "LOST_CLAIM"
    error = F.when(held, F.when(~refused & spent, "attempt_budget_exhausted").otherwise(F.col("category")))
    again = F.when(F.col("outcome") == "RETRY_SCHEDULED", F.lit(now) + F.when(F.col("disposition") == "RETRY_60_MINUTES", 3600).otherwise(900))
    total = [F.when(held, F.coalesce(F.col(f"_{k}"), F.lit(0)) + F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in USAGE]
    return c.select(*KEY, "outcome", error.alias("error"), again.alias("next_attempt_at"), *total)


def price(usage: DataFrame, schedule: DataFrame) -> DataFrame:
    """usage (usage_id, model, at in seconds, hit, miss, output) with its cost; each use must fall into exactly one window of its model, or the query fails.

    The schedule is a dimension of a few rows (checked): its rows travel to the uses, a list a model, so uses stay where they are.
    """
    if schedule.count() > 10_000:
        raise ValueError("a price schedule of this size is not a dimension")
    lists = schedule.groupBy(F.col("model").alias("_model")).agg(F.collect_list(F.struct(*schedule.columns)).alias("_rows"))
    minute = F.pmod(F.floor(F.col("at") / 60), F.lit(1440))
    covers = lambda w: (F.col("at") >= w["effective_from"]) & (F.col("at") < F.coalesce(w["effective_until"], F.lit(1 << 60))) & (minute >= w["start_minute"]) & (minute < w["end_minute"])
    rows = usage.join(F.broadcast(lists), F.col("model") == F.col("_model"), "left").withColumn("_hits", F.filter(F.coalesce("_rows", F.array().cast(lists.schema["_rows"].dataType)), covers))
    one = F.when(F.size("_hits") != 1, F.raise_error(F.concat(F.lit("expected one price of "), F.coalesce("model", F.lit("null")), F.lit(" at "), F.col("at").cast("string"), F.lit(", found "), F.size("_hits").cast("string")))).otherwise(F.col("_hits")[0])
    rows = rows.select("usage_id", "hit", "miss", "output", one.alias("w"))
    cost = ((F.col("hit") * F.col("w.hit_rate") + F.col("miss") * F.col("w.miss_rate") + F.col("output") * F.col("w.output_rate")) / F.lit(1_000_000)).cast("decimal(24,12)")
    return rows.select("usage_id", F.col("w.pricing_id").alias("pricing_id"), F.col("w.window").alias("window"), cost.alias("cost"))
