"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import apart, stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Nodes with the smallest node they reach: (node, root). Nodes are longs; a loop or a repeated edge is harmless.

    Large-star and small-star steps in turn until nothing changes, logarithmic in the diameter in practice. Each round is written to
    the shared folder. A node of high degree is met by partial aggregation and by joins that may split it, never by one group.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = stored(edges)
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(apart(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(apart(least), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        small = stored(small.select("e.*").where("a <> b").distinct())
        after = _mark(small)
        edges, mark, before = small, after, mark
        if after == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
