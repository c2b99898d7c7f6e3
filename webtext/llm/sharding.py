"""Shards by rendezvous hashing of a stable record key. Native operations only.

Every shard draws a number from the key and the shard's own index; the record goes to
the shard with the least ``-ln(u) / weight``, so a shard gets records in proportion to
its weight. One shard more changes nothing among the old ones: a record either stays or
goes to the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.llm.common import prefix_sums


def draw(key: str | Column, shard: Column) -> Column:
    """Number between 0 and 1, both excluded, fixed by key and shard index."""
    bits = F.shiftrightunsigned(F.xxhash64(key, shard.cast("long")), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def cost(key: str | Column, shard: Column, weight: Column) -> Column:
    return -F.ln(draw(key, shard)) / weight


def best(key: str | Column, weights: list[float]) -> Column:
    """Struct of the least cost and the shard that has it. Weights of 0 take nothing."""
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a positive weight")
    shards = F.transform(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w > 0]),
        lambda s: F.struct(cost(key, s["i"], s["w"]).alias("cost"), s["i"].alias("shard")),
    )
    return F.array_min(shards)


def assign(df: DataFrame, key: str, weights: list[float], next_weight: float = 1.0) -> DataFrame:
    """``df`` with ``shard``, and ``grown_shard`` when one shard of ``next_weight`` is added.

    A function of the key alone: rows with one key share a shard, null keys included,
    and nothing is shuffled.
    """
    out = df.drop("shard", "grown_shard").withColumn("_best", best(key, weights))
    n = len(weights)
    grown = cost(key, F.lit(n), F.lit(float(next_weight))) if next_weight > 0 else F.lit(float("inf"))
    return out.select(
        *[c for c in out.columns if c != "_best"],
        F.col("_best.shard").alias("shard"),
        F.when(grown < F.col("_best.cost"), n).otherwise(F.col("_best.shard")).alias("grown_shard"),
    )


def number_in_shards(df: DataFrame, *order: str) -> DataFrame:
    """Add ``slot`` = 0, 1, 2 … within each shard in the given order.

    A shard is numbered in parts (see ``prefix_sums``), never in one task.
    """
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return prefix_sums(one, ["shard"], list(order), slot="_one").drop("_one")
