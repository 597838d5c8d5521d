"""A model as an injected function: what it says is checked, and what it uses is counted.

The function gets a batch of inputs and gives a batch of answers; it runs on the executors over Arrow
batches, so a client is opened once a batch.  Tests inject a function that needs no network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.checks import canonical_markets, canonical_topics, consistent_labels
from plumbline.session import ship

ANSWER = "is_relevant boolean, markets array<string>, category string, topics array<string>, confidence double, prompt_tokens long, prompt_cache_hit_tokens long, completion_tokens long, failure string, retryable boolean, provider_attempts int"


def apply_model(inputs: DataFrame, answer: Callable[[pd.DataFrame], pd.DataFrame], *, key: str = "article_id") -> DataFrame:
    """inputs (key, input: the fields of normalize.model_input) with outcome, labels and usage.

    answer gets a frame of the input's fields and gives one of ANSWER's columns, a row for each row.  An
    answer that tells a failure is FAILED with its category; one that breaks the contract is FAILED as
    INVALID_OUTPUT and may be retried; others are SUCCEEDED.
    """
    ship(inputs.sparkSession)
    kind = inputs.schema[key].dataType.simpleString()
    names = [c.strip().split(" ")[0] for c in ANSWER.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            said = answer(batch.drop(columns=[key]).reset_index(drop=True))
            if len(said) != len(batch):
                raise ValueError("a model answers each input once")
            yield pd.concat([batch[[key]].reset_index(drop=True), said[names].reset_index(drop=True)], axis=1)

    said = inputs.select(key, "input.*").mapInPandas(run, f"{key} {kind}, {ANSWER}")
    good = canonical_markets(F.col("markets")) & canonical_topics(F.col("topics")) & consistent_labels(F.col("is_relevant"), F.col("category"), F.col("markets"), F.col("topics")) & F.col("confidence").between(0, 1)
    used = (F.col("prompt_cache_hit_tokens") >= 0) & (F.col("prompt_tokens") >= F.col("prompt_cache_hit_tokens")) & (F.col("completion_tokens") >= 0)
    failure = F.when(F.col("failure").isNotNull(), F.col("failure")).when(~F.coalesce(used, F.lit(False)), "INVALID_USAGE").when(~F.coalesce(good, F.lit(False)), "INVALID_OUTPUT")
    ok = failure.isNull()
    labels = [F.when(ok, F.col(c)).alias(c) for c in ("is_relevant", "markets", "category", "topics", "confidence")]
    usage = [F.coalesce("prompt_tokens", F.lit(0)).alias("prompt_tokens"), F.coalesce("prompt_cache_hit_tokens", F.lit(0)).alias("prompt_cache_hit_tokens"), F.coalesce("completion_tokens", F.lit(0)).alias("completion_tokens")]
    return said.select(key, F.when(ok, "SUCCEEDED").otherwise("FAILED").alias("outcome"), failure.alias("failure_category"), F.when(~ok, F.coalesce("retryable", F.lit(True))).alias("retryable"), *labels, *usage, "provider_attempts")
