"""Counters of runs: each is a sum over rows that other operators give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_totals(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per run: cells_attempted and the sums of request_count, raw_result_count, invalid_record_count, unique_candidate_count and admitted_count."""
    summed = ("request_count", "raw_result_count", "invalid_record_count", "unique_candidate_count", "admitted_count")
    return cells.groupBy(*keys).agg(F.count("*").alias("cells_attempted"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed])


def window_totals(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Per cell: whether all its windows are complete, the requests and the records of its windows."""
    return windows.groupBy(*keys).agg(F.bool_and("complete").alias("complete"), F.count("*").alias("request_count"), F.sum("records").alias("provider_record_count"))


def matching(work: DataFrame, prefs: DataFrame, outcomes: DataFrame, work_page: int = 100, preference_page: int = 100) -> DataFrame:
    """One row: preferences and work items seen and their pages, pairs, and pairs by what became of them.

    outcomes: a row a candidate, CREATED or ALREADY_EXISTS; all other pairs are no match.
    """
    pages = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size))
    counted = work.agg(F.count("*").alias("work_items_seen")).crossJoin(prefs.agg(F.count("*").alias("preferences_loaded"))).crossJoin(
        outcomes.agg(F.count_if(F.col("outcome") == "CREATED").alias("candidate_created_count"), F.count_if(F.col("outcome") == "ALREADY_EXISTS").alias("candidate_already_exists_count"))
    )  # of one row each
    pairs = F.col("work_items_seen") * F.col("preferences_loaded")
    return counted.select(
        "preferences_loaded", pages(F.col("preferences_loaded"), preference_page).alias("preference_pages_read"), pages(F.col("work_items_seen"), work_page).alias("work_pages_read"), "work_items_seen",
        pairs.alias("pairs_evaluated"), (pairs - F.col("candidate_created_count") - F.col("candidate_already_exists_count")).alias("no_match_count"), "candidate_created_count", "candidate_already_exists_count",
    )


def batch(items: DataFrame, keys: list[str]) -> DataFrame:
    """Per batch: claims by outcome, provider attempts and cost.  items: outcome (SUCCEEDED, RETRY_SCHEDULED, QUARANTINED, LOST_CLAIM), provider_attempts, estimated_cost_usd."""
    of = lambda o: F.count_if(F.col("outcome") == o)
    return items.groupBy(*keys).agg(
        F.count("*").alias("claimed"), of("SUCCEEDED").alias("succeeded"), of("RETRY_SCHEDULED").alias("retry_scheduled"), of("QUARANTINED").alias("quarantined"), of("LOST_CLAIM").alias("lost_claim"),
        F.coalesce(F.sum("provider_attempts"), F.lit(0)).alias("provider_attempts"), F.coalesce(F.sum("estimated_cost_usd"), F.lit(0)).alias("estimated_cost_usd"),
    )
