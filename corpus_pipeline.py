"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of docs.  Each judges
all that its predecessor kept.

Edge cases: rows with a null id are judged like others, but the Jaccard join drops none of them; rows
with a null or empty text fail the quality rules; of rows that share an id and whose document stays,
the one with the least hash of its text (then of all its columns) stays; rows that are equal in all
columns are one; very long texts are handled whole; an empty table gives an empty result; other columns
are carried along under any names but those that begin with `__stage_`.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, decontaminate, ngram_join, quality, substring_dedup
from plumbline.llm.common import checkpoint_folder, checkpointed
from plumbline.llm.queries import ship, vocabulary_path
from plumbline.session import table

#: Rows of ids that may be broadcast to drop documents; more are dropped by a shuffled join.
BROADCAST_ROWS = 1_000_000
_MARK = "__stage_"


def _sent(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the log-likelihood threshold go."""
    ship(spark)
    ratio = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, ratio, prefix=_MARK).filter(F.col(_MARK + "kept")).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays, once; rows with a null id stay."""
    ship(spark)
    found = checkpointed(ngram_join.jaccard_components(docs))
    gone = found.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias(_MARK + "id")).distinct()
    kept = docs.join(_sent(gone), F.col("doc_id") == F.col(_MARK + "id"), "left_anti")
    twice = found.filter((F.col("component_id") == F.col("doc_id"))).groupBy(F.col("doc_id").alias(_MARK + "id")).agg(F.count("*").alias(_MARK + "n")).filter(F.col(_MARK + "n") > 1).select(_MARK + "id")
    if not twice.isEmpty():  # rows that repeat an id
        twice = _sent(twice)
        same = F.col("doc_id") == F.col(_MARK + "id")
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        one = kept.join(twice, same, "left_semi").groupBy("doc_id").agg(F.min_by(whole, F.struct(F.xxhash64("text"), F.xxhash64(whole))).alias(_MARK + "row"))
        kept = kept.join(twice, same, "left_anti").unionByName(one.select(_MARK + "row.*"))
    return kept


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out of the text; n_chars follows it."""
    ship(spark)
    found = substring_dedup.substring_dedup(docs, prefix=_MARK)
    cut = F.col(_MARK + "n_removed") > 0
    new = {"text": F.when(cut, F.col(_MARK + "kept_text")).otherwise(F.col("text")), "n_chars": F.when(cut, F.length(_MARK + "kept_text").cast("long")).otherwise(F.col("n_chars").cast("long")) if "n_chars" in docs.columns else None}
    return found.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"`{c}`") for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    gone = checkpointed(found.filter(decontaminate.contaminated()).select(F.col("doc_id").alias(_MARK + "id"), F.col("text_hash").alias(_MARK + "hash")).distinct())
    return docs.join(_sent(gone), F.col("doc_id").eqNullSafe(F.col(_MARK + "id")) & (F.xxhash64("text") == F.col(_MARK + "hash")), "left_anti")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number and the digests of ids and decoded text."""
    ship(spark)
    return bpe.encode_decode(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_removal),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: The quality rules' hashed byte counts and the tokens have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared folder."""
    folder = os.path.join(checkpoint_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
