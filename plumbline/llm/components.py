"""Connected components by alternating large-star and small-star steps (a published method).

Every step is a grouped minimum and a join, both over links; no component is ever gathered in a task.
Each round is written to the shared checkpoint folder, so plans stay short and lost executors cost
one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (ids) -> node, root: the smallest id that each linked node reaches, for all nodes but roots.

    Rounds go on until nothing changes, which takes about the square of the logarithm of the largest component.
    """
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _print(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).filter("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("k")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(small.unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct())
        now = _print(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
