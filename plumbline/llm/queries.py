"""The queries of this subpackage and, where SQL can say the same, the SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import session
from plumbline.session import table

from . import bpe, decontaminate, html_extract, langid, ngram_join, quality, sharding, substring_dedup, token_counts, toxicity
from .common import checkpoint_folder, checkpointed, held_out
from .sql import ORACLES

BATCH_ROWS = 2_000


def ship(spark: SparkSession) -> None:
    """Readies a session: this package on the executors, and smaller Arrow batches, as texts are long rows.

    The batch size stays as it is set here for the rest of the session: plans read it when they run.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    session.ship(spark)


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False).drop("text")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("llr")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.language_id(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), with_ids=False)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded, all counts revised by the end-of-text token, later copies deleted; two batches come twice."""
    counts = checkpointed(token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"), "byte_bpe_50k"))
    ledger = token_counts.Ledger(spark, f"{checkpoint_folder(spark)}/token-ledger-{uuid.uuid4().hex}")
    ledger.commit("load", token_counts.inserts(counts))
    ledger.commit("load", token_counts.inserts(counts))
    revised = counts.select("doc_id", (F.col("n_tokens") + 1).alias("new_tokens"))
    ledger.commit("end-of-text", token_counts.revisions(counts, revised))
    state = counts.withColumn("n_tokens", F.col("n_tokens") + 1)
    gone = token_counts.later_copies(state)
    ledger.commit("copies", token_counts.deletes(state, gone))
    ledger.commit("copies", token_counts.deletes(state, gone))
    return ledger.totals()


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleave(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_ALL = (op1_toxicity, op2_substring_dedup, op3_ngram_jaccard_join, op4_quality_rules, op5_language_id, op6_bpe, op7_token_counts, op8_benchmark_decontamination, op9_html_extraction, op10_sharding)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _query(f) for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
