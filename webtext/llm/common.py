"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webtext.sources.shared import materialize

# Words are runs of anything but ASCII white space; ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"


# Texts can be long: few rows at once come from a file and go to a Python worker.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def small_batches(spark: SparkSession) -> None:
    """Set ``BATCHES`` for the session. They are read when a job starts, so they stay set;
    results do not depend on them."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, groups: list[str], order: list[str | Column], most: dict[str, str] = {}, **values: str) -> DataFrame:
    """Rows with, for each ``name=column`` of ``values``, the sum of ``column`` over the
    earlier rows of the same group (0 for the first), and for each of ``most`` their
    largest value (null for the first). Null group values form a group.

    No group is brought into one task: rows are range-partitioned by group and order
    and written once (boundaries come from a sample, so they must not be drawn twice),
    sums start anew in each written part, and the totals of the earlier parts of the
    same group are added. Ties beyond ``order`` are cut by the row's place in its scan.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in (*groups, *order)]
    ids = F.monotonically_increasing_id()
    rows = df.withColumn("_tie", ids)
    rows = materialize(
        rows.repartitionByRange(*keys, "_tie")
        .sortWithinPartitions(*keys, "_tie")
        .withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33)),
        "prefix",
    )
    inside = Window.partitionBy("_part", *groups).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    scans = {n: (c, F.sum, lambda a, b: F.coalesce(a, zero) + F.coalesce(b, zero)) for n, c in values.items()}
    scans |= {n: (c, F.max, F.greatest) for n, c in most.items()}
    totals = rows.groupBy("_part", *groups).agg(*[f(c).alias(f"_all_{n}") for n, (c, f, _) in scans.items()])
    totals = totals.select("_part", *groups, *[f(f"_all_{n}").over(earlier).alias(f"_all_{n}") for n, (_, f, _) in scans.items()])
    on = F.col("r._part") == F.col("t._part")
    for g in groups:
        on = on & F.col(f"r.{g}").eqNullSafe(F.col(f"t.{g}"))
    placed = rows.select("*", *[f(c).over(inside).alias(n) for n, (c, f, _) in scans.items()])
    kept = [c for c in placed.columns if c not in ("_tie", "_part", *scans)]
    both = placed.alias("r").join(totals.alias("t"), on)
    added = [add(F.col(f"r.{n}"), F.col(f"t._all_{n}")).alias(n) for n, (_, _, add) in scans.items()]
    return both.select(*[F.col(f"r.`{c}`") for c in kept], *added)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]
