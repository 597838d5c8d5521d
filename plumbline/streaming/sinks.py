"""Sinks: Structured Streaming variants, idempotent by batch, a dry run, and records as a JSON contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.discovery import SAMPLES, fold_daily
from plumbline.operators.match import first_write_wins

#: Parts of a table by key: a batch reads only the parts that its keys are in.
BUCKETS = 64


def _bucketed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def add_new(batch: DataFrame, batch_id: int, path: str, keys: list[str], seq: str) -> None:
    """Adds the first row of each key that the table at path lacks, under the batch's own folder; a batch that runs again writes the same."""
    spark, rows = batch.sparkSession, _bucketed(batch, keys)
    touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # BUCKETS at most
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(hadoop):
        stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    else:
        stored = rows.limit(0).withColumn("batch", F.lit(-1).cast("long"))
    before = stored.filter((F.col("batch") < batch_id) & F.col("bucket").isin(touched))  # its own earlier try doesn't count
    first_write_wins(rows, before, keys, seq).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={batch_id}")


def append_new(stream: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str) -> StreamingQuery:
    """A stream into add_new."""
    return stream.writeStream.foreachBatch(lambda batch, batch_id: add_new(batch, batch_id, path, keys, seq)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(stream: DataFrame, at: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Counts, first and last times per UTC day and key over a stream, with a watermark for late rows; state holds open days only."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("day"), *keys).agg(F.count("*").alias("observation_count"), F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"))


def add_fold(batch: DataFrame, batch_id: int, path: str, keys: list[str], at: str, seq: str, sample: Column) -> None:
    """The daily fold of one batch, under the batch's own folder; a batch that runs again writes the same."""
    fold_daily(batch, keys, at, seq, sample).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def append_folds(stream: DataFrame, path: str, checkpoint: str, keys: list[str], at: str, seq: str, sample: Column) -> StreamingQuery:
    """A stream into add_fold."""
    return stream.writeStream.foreachBatch(lambda batch, batch_id: add_fold(batch, batch_id, path, keys, at, seq, sample)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def folds(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """All batches' folds as one, samples of earlier batches first."""
    every = spark.read.parquet(path)
    g = every.groupBy("observation_day", *keys).agg(F.sum("observation_count").alias("observation_count"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), F.array_sort(F.collect_list(F.when(F.size("samples") > 0, F.struct("batch", "samples")))).alias("_s"))
    return g.withColumn("samples", F.slice(F.flatten(F.transform("_s", lambda x: x["samples"])), 1, SAMPLES)).drop("_s")


def dry_run(rows: DataFrame, keys: list[str]) -> DataFrame:
    """What a sink would be given, counted by key; nothing is written."""
    return rows.groupBy(*keys).count()


def contract(rows: DataFrame, columns: list[str]) -> DataFrame:
    """key, json: rows as compact JSON objects of the contract's columns, keys in order, nulls told."""
    return rows.select(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}).alias("json"))


def export_contract(rows: DataFrame, columns: list[str], path: str, *, check: bool = False) -> int:
    """Writes the contract's records to path; with check, writes nothing and counts the records that differ from what is there."""
    new = contract(rows, columns)
    if not check:
        new.write.mode("overwrite").text(path)
        return 0
    old = rows.sparkSession.read.text(path).withColumnRenamed("value", "json")
    return new.exceptAll(old).unionByName(old.exceptAll(new)).count()
