"""Proportional stratified interleaving of rows into shards.

Rows of each source are put in a seeded random order, by a hash of id, text checksum and size.  Row
k (from 0) of a source of n rows gets the fractional rank (2k + 1) / 2n; sorting all rows by it
spreads every source evenly over the whole sequence, and cutting the sequence into equal runs gives
shards that all match the mixture.  Law `rows`: shard sizes differ by one at most.

No source and no shard is ever one task.  Ranks are found in two levels: random order values fall
into about sqrt(N) ranges, ranges are counted and their offsets summed, and rows are numbered
within their range only.  The same is done for fractional ranks, which are uniform by nature.  Rows
that are equal in source, id, checksum and size are interchangeable: they are ranked as one row with
a count, and come apart again before the second level, so no number of them makes a range large.

Groups: equal texts are not kept together under this law (one group may be larger than a shard).

Edge cases: null texts have size 8 and the crc32 of nothing, very long ones are read whole; null
sources are a stratum of their own, null ids are told apart by their texts; ties in the random order
fall back to id, checksum and size, ties of the fractional rank to the source and the random order
(nulls first); an empty table gives an empty result.  Only doc_id, source and text are read, so other
columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed

SHARDS = 24
SEED = "mixture-1"
OVERHEAD = 8
_BITS = 60


#: Equal rows that one task may take apart.
APART = 10_000


def random_order(seed: str, *parts: Column) -> Column:
    """60 bits of the parts' SHA-256 under a seed: the same on every run and in any SQL engine."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _apart(groups: DataFrame, count: str) -> DataFrame:
    """A row for each of `count` equal rows, with its number `copy` among them; large groups over many tasks."""
    zero, step = F.lit(0).cast("long"), F.lit(APART).cast("long")
    few = groups.filter(F.col(count) <= APART).withColumn("copy", F.explode(F.sequence(zero, F.col(count) - 1)))
    many = groups.filter(F.col(count) > APART).withColumn("_from", F.explode(F.sequence(zero, F.col(count) - 1, step)))
    many = many.repartition(F.xxhash64("r", "_from"))
    many = many.withColumn("copy", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + APART, F.col(count)) - 1))).drop("_from")
    return few.unionByName(many)


def interleave(docs: DataFrame, *, shards: int = SHARDS, seed: str = SEED, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per row: doc_id, source, size, text_crc32, position (global), shard, slot."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    kinds = ["doc_id", "source", "size", "text_crc32"]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    groups = checkpointed(rows.groupBy(*kinds).agg(F.count("*").alias("copies")))
    total = int(groups.agg(F.sum("copies").alias("n")).first()["n"] or 0)
    bits = max(0, math.ceil(math.log2(max(total, 1)) / 2))
    ranges = 1 << bits
    groups = groups.withColumn("r", random_order(seed, F.col("doc_id"), F.col("text_crc32"), F.col("size"))).withColumn("part", F.shiftright("r", _BITS - bits).cast("int"))
    tie = ["r", "doc_id", "text_crc32", "size"]

    # Rank within the source: rows of the ranges before, and the place within the range.
    by_source = Window.partitionBy("c_source").orderBy("c_part")
    counts = groups.groupBy(F.col("source").alias("c_source"), F.col("part").alias("c_part")).agg(F.sum("copies").alias("c"))
    counts = counts.select("c_source", "c_part", (F.sum("c").over(by_source) - F.col("c")).alias("before"), F.sum("c").over(Window.partitionBy("c_source")).alias("n_source"))
    in_part = Window.partitionBy("source", "part").orderBy(*tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = groups.withColumn("first", F.sum("copies").over(in_part) - F.col("copies"))
    placed = placed.join(counts, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("part") == F.col("c_part")))
    placed = _apart(placed.select(*kinds, "r", "copies", (F.col("before") + F.col("first")).alias("first"), "n_source"), "copies")
    placed = placed.withColumn("f", (2 * (F.col("first") + F.col("copy")) + 1) / (2 * F.col("n_source")))
    placed = placed.select(*kinds, "r", "f", F.floor(F.col("f") * ranges).cast("int").alias("slice"))

    # Place in the whole sequence, the same way.
    slices = placed.groupBy(F.col("slice").alias("c_slice")).agg(F.count("*").alias("c"))
    slices = slices.select("c_slice", (F.sum("c").over(Window.orderBy("c_slice")) - F.col("c")).alias("before"))
    ordered = placed.withColumn("k", F.row_number().over(Window.partitionBy("slice").orderBy("f", "source", *tie)) - 1)
    ordered = ordered.join(slices, F.col("slice") == F.col("c_slice")).withColumn("position", F.col("before") + F.col("k"))
    n = max(total, 1)
    ordered = ordered.withColumn("shard", F.expr(f"cast(position * {shards} div {n} as int)"))
    return ordered.select(*kinds, "position", "shard", F.expr(f"position - (cast(shard as bigint) * {n} + {shards - 1}) div {shards}").alias("slot"))


def write_shards(rows: DataFrame, path: str, *, shards: int = SHARDS) -> None:
    """Rows that carry shard and slot, written in slot order under shard=<k> folders."""
    rows.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
