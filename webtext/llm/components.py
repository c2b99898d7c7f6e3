"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.sources.shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (``a, b``, numbers), root the least node
    of its component.

    Large-star and small-star steps in turn until nothing changes: every node is linked
    to the least of its neighbours, by grouped minima (combined before the shuffle) that
    are joined back, so a node with very many neighbours is no single group. Each round
    is written, which cuts the lineage.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = materialize(small.union(least.select("u", "m")).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
