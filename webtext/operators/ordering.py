"""Global order without a single sorting task.

``row_number()`` over an unpartitioned window and a large ``limit`` both pull
every row into one task. Here rows are range-partitioned and sorted, the sizes
of the partitions give each one its offset, and position = offset + place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.sources.shared import materialize

# A sorted limit up to this many rows is merged on the driver by Spark itself.
TOP_K_ROWS = 10_000
# A key with more rows than this is cut into blocks.
HOT_ROWS = 1_000_000


def number_rows(df: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """Add ``name`` = 0, 1, 2 … in the given total order.

    The sorted rows are written once, since range boundaries come from a sample
    and must be the same for the rows and for the partition sizes. The sizes
    table has one row per partition, so it is safe to broadcast.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ids = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_part", F.shiftright(ids, 33))
        .withColumn("_place", ids.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = materialize(placed, "numbered")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in order; a large ``n`` is cut by position, not by one task.

    ``order`` must be total: among ties either way may keep other rows.
    """
    if n <= TOP_K_ROWS:
        return df.orderBy(*order).limit(n)
    return number_rows(df, *order, name="_pos").where(F.col("_pos") < n).drop("_pos")


def sorted_urls(urls: DataFrame) -> DataFrame:
    """Distinct URLs with their position in code-point order."""
    return number_rows(urls.select("url").distinct(), "url")


def shuffled_key(column: str, seed: int) -> Column:
    """Sort key of a seeded pseudo-random order: the same on every run."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(column).cast("string")))


def random_order(urls: DataFrame, seed: int) -> DataFrame:
    """Position of every URL in a seeded pseudo-random visiting order."""
    keyed = urls.select("url").distinct().withColumn("_key", shuffled_key("url", seed))
    return number_rows(keyed, "_key", "url").drop("_key")


def recent_pages(metadata: DataFrame, start, end, k: int) -> DataFrame:
    """Newest ``k`` pages with ``start <= created_at < end``.

    A top-k plan for small ``k``: every task keeps its own ``k`` rows; a large
    ``k`` is cut by position (see ``first_rows``) and its rows are sorted by ranges. Ids
    must be unique among rows of one time. On a table written by
    ``append_metadata`` the date bounds also prune partitions.
    """
    bounds = [F.lit(b) if not isinstance(b, Column) else b for b in (start, end)]
    in_range = (F.col("created_at") >= bounds[0]) & (F.col("created_at") < bounds[1])
    if "created_date" in metadata.columns:
        in_range &= (F.col("created_date") >= F.to_date(bounds[0])) & (
            F.col("created_date") <= F.to_date(bounds[1])
        )
    order = (F.col("created_at").desc(), F.col("id"))
    newest = first_rows(metadata.where(in_range), k, *order)
    return newest if k <= TOP_K_ROWS else newest.orderBy(*order)


def in_blocks(df: DataFrame, keys: list[str], position: str, block: int, hot_rows: int) -> DataFrame:
    """Add ``_block`` and ``_hot``: keys with more than ``hot_rows`` rows are cut
    into blocks of ``block`` consecutive positions, others are one block.

    Counting combines on the map side. Hot keys number at most the rows of
    ``df`` divided by ``hot_rows``, so their list can be broadcast. Without
    keys everything is one hot group.
    """
    cut = F.expr(f"{position} div {block}")
    if not keys:
        return df.withColumn("_hot", F.lit(True)).withColumn("_block", cut)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = counts.where(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    marked = df.join(F.broadcast(hot), keys, "left")
    return marked.withColumn("_block", F.when(F.col("_hot"), cut).otherwise(F.lit(0).cast("bigint")))


def running_total(
    df: DataFrame,
    keys: list[str],
    position: str,
    value: str,
    name: str,
    block: int = 100_000,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``name`` = sum of ``value`` up to and including each row, per ``keys``.

    Rows are summed inside blocks, and block totals of hot keys are carried
    forward, so one hot key is shared by many tasks.
    """
    blocked = in_blocks(df, keys, position, block, hot_rows)
    inside = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(
        Window.unboundedPreceding, 0
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.where("_hot").groupBy(*keys, "_block").agg(F.sum(value).alias("_total"))
    carried = totals.select(*keys, "_block", F.sum("_total").over(before).alias("_carried"))
    return (
        blocked.withColumn("_inside", F.sum(value).over(inside))
        .join(carried, [*keys, "_block"], "left")
        .withColumn(name, F.col("_inside") + F.coalesce("_carried", F.lit(0)))
        .drop("_block", "_hot", "_inside", "_carried")
    )


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
