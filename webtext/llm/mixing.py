"""Mixing of sources to target weights along a curriculum. Native operations only.

Each source has a target (words to take) and a weight schedule over training time
0 to 1, piecewise linear. The integral of the schedule is the source's cumulative
demand. A source's documents stand in a fixed hashed order, epoch after epoch; the
document that starts after ``c`` words gets the time at which demand reaches ``c``.
Documents of all sources are then range-sorted by that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.common import let, prefix_sums, word_count

# Rates at times 0 and 1 of a source by its place among the sources: falling, level, rising.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """``source, source_size, place, target`` of each row ``source, source_size``.

    Sources in code-point order, null last, take ``weights`` in turn and share ``share``
    times all words by weight; a target stops at ``most`` times its source's size and the
    excess is shared again by weight until none is above. That fixed point is a water
    level: with sources sorted by size over weight, those up to some place are full and
    the others get the same words per weight. One row per source, from an aggregation.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    placed = placed.withColumn("_w", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")))
    placed = placed.withColumn("_cap", F.col("source_size") * float(most))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = placed.withColumn("_level", left / F.sum("_w").over(onward))
    open_level = F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level"))
    level = level.withColumn("_level", F.min(F.struct(F.when(open_level.isNull(), 1).otherwise(0), F.col("_cap") / F.col("_w"), open_level)).over(everything)["col3"])
    share_of = F.coalesce(F.least("_cap", F.col("_level") * F.col("_w")), F.col("_cap"))
    return level.select("source", "source_size", "place", share_of.alias("target"))


def time_of(done: Column, start: Column, end: Column) -> Column:
    """Time at which the integral of the rate that goes from ``start`` to ``end`` over
    0 to 1 reaches the part ``done`` (0 to 1) of its whole."""
    slope = end - start
    whole = (start + end) / 2 * done
    root = F.sqrt(F.greatest(start * start + 2 * slope * whole, F.lit(0.0)))
    return F.when(slope == 0, done).otherwise((root - start) / slope)


def hashed_order(key: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), key, text)


def plan(
    docs: DataFrame,
    weights: list[float],
    share: float = 1.5,
    most: float = 2.0,
    schedules=SCHEDULES,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, takes, taken``.

    ``takes`` lists the epochs in which the document is trained on, as structs of
    ``position`` (0 to 1) and ``words``. The document at which a source's demand ends is
    trained on as far as the demand goes, so each source takes its target to the word;
    an epoch takes a document once, so none exceeds ``ceil(most)`` times its size.
    Null text has size 0; empty documents take nothing and are in no epoch. The order
    within a source is a hash of id and text, ties by all given columns: reruns agree.
    """
    words = docs.select("doc_id", "source", word_count("text").alias("size"), hashed_order("doc_id", "text", seed).alias("_h"))
    sizes = words.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(sizes, weights, share, most)
    rows = prefix_sums(words, ["source"], ["_h", "doc_id", "size"], _start="size")
    rows = rows.alias("d").join(wanted.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    rows = rows.select("d.*", *[f"s.{c}" for c in ("source_size", "place", "target")])
    kind = (F.col("place") % len(schedules) + 1).cast("int")
    first, last = (F.element_at(F.array(*[F.lit(float(s[i])) for s in schedules]), kind) for i in (0, 1))

    def take(epoch: Column) -> Column:
        begin = epoch * F.col("source_size") + F.col("_start")
        left = F.round(F.col("target")).cast("long") - begin
        position = time_of(F.least(F.try_divide(begin, "target"), F.lit(1.0)), first, last)
        return F.struct(position.alias("position"), F.greatest(F.least(F.col("size"), left), F.lit(0)).cast("long").alias("words"))

    epochs = F.sequence(F.lit(0).cast("long"), F.lit(max(0, -int(-most // 1) - 1)).cast("long"))
    takes = F.filter(F.transform(epochs, take), lambda t: t["words"] > 0)
    return rows.select(
        "doc_id", "source", "_h", "size", "source_size", "target",
        let(takes, lambda t: F.struct(t.alias("takes"), F.aggregate(t, F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"))).alias("_t"),
    ).select("doc_id", "source", "_h", "size", "source_size", "target", "_t.takes", "_t.taken")


def in_order(planned: DataFrame) -> DataFrame:
    """Rows of ``plan`` range-sorted by ``position``, the place (0 to 1) of a document's first
    epoch, with ``positions`` of all its epochs. Documents in no epoch have null and none and
    come last; ties go by id (null first), then hash."""
    placed = planned.withColumn("positions", F.col("takes.position")).withColumn("position", F.get("positions", F.lit(0)))
    order = (F.col("position").asc_nulls_last(), F.col("doc_id"), F.col("_h"))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed(docs: DataFrame, weights: list[float], seed: int = 0, **options) -> DataFrame:
    """``docs`` in training order: each document once per epoch that takes it, whole.

    Documents that no epoch takes are left out; one taken twice comes again at its later
    place. Rows equal in id and text are copies: each keeps its own takes, and where
    their other columns differ, those of one of them stand for all. Columns that the
    plan uses may occur in ``docs``; the columns returned are those of ``docs``.
    """
    takes = plan(docs, weights, seed=seed, **options).select("doc_id", "_h", F.explode("takes").alias("_take"))
    times = takes.select("doc_id", "_h", F.col("_take.position").alias("_position"))
    keyed = docs.withColumn("_h", hashed_order("doc_id", "text", seed)).dropDuplicates(["doc_id", "_h"])
    on = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d._h") == F.col("t._h"))
    placed = keyed.alias("d").join(times.alias("t"), on).select("d.*", "t._position")
    order = ("_position", "doc_id", "_h")
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in docs.columns])
