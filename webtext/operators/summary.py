"""Extractive summaries by in-document word frequency, inside one row.

A sentence scores the mean frequency, within its document, of its words. By
score (ties by position) sentences are taken while the words ranked before are
fewer than ``min_words`` and the words ranked up to and including it are at
most ``max_words``; those taken are put out in text order.

Everything is sorting and slicing of arrays in the document's own row: no
shuffle, and the cost is n log n in the length of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import text as T


def _run_starts(items: Column, field: str) -> Column:
    """1-based positions where ``field`` changes in a sorted array."""
    places = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items))).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(
        places,
        lambda k: (k == 1) | (F.get(items, k - 1)[field] != F.get(items, k - 2)[field]),
    )


def _run_ends(items: Column, starts: Column) -> Column:
    """Last position of each run, aligned with ``starts``."""
    return F.transform(starts, lambda s, r: F.coalesce(F.get(starts, r + 1) - 1, F.size(items)))


def summarize(
    docs: DataFrame,
    max_words: int = T.MAX_SUMMARY_WORDS,
    min_words: int = T.MIN_SUMMARY_WORDS,
) -> DataFrame:
    """Add ``summary`` and ``summary_sentences``; NULL when no sentence fits."""
    sentences = F.transform(
        T.segments(F.col("text")),
        lambda s, i: F.struct(i.alias("i"), F.trim(s).alias("s"), T.words(s).alias("w")),
    )
    out = docs.withColumn("_sent", F.filter(sentences, lambda s: F.size(s["w"]) > 0))
    # Every word with its sentence, sorted so that equal words are neighbours.
    occurrences = F.flatten(
        F.transform(
            F.col("_sent"),
            lambda s: F.transform(s["w"], lambda w: F.struct(w.alias("w"), s["i"].alias("i"))),
        )
    )
    out = out.withColumn("_occ", F.sort_array(occurrences))
    out = out.withColumn("_starts", _run_starts(F.col("_occ"), "w"))
    # Each occurrence is worth the length of its run; sorted back by sentence.
    lengths = F.zip_with(
        F.col("_starts"), _run_ends(F.col("_occ"), F.col("_starts")), lambda s, e: e - s + 1
    )
    worth = F.zip_with(
        F.col("_occ"),
        F.flatten(F.transform(lengths, lambda n: F.array_repeat(n, n))),
        lambda o, n: F.struct(o["i"].alias("i"), n.alias("f")),
    )
    out = out.withColumn("_occ", F.sort_array(worth))
    out = out.withColumn("_starts", _run_starts(F.col("_occ"), "i"))
    totals = F.zip_with(
        F.col("_starts"),
        _run_ends(F.col("_occ"), F.col("_starts")),
        lambda s, e: F.aggregate(
            F.sequence(s, e), F.lit(0).cast("bigint"), lambda acc, k: acc + F.get(F.col("_occ"), k - 1)["f"]
        ),
    )
    ranked = F.sort_array(
        F.zip_with(
            F.col("_sent"),
            totals,
            lambda s, t: F.struct(
                (-(t.cast("double") / F.size(s["w"]))).alias("rank"),
                s["i"].alias("i"),
                F.size(s["w"]).alias("n"),
                s["s"].alias("s"),
            ),
        )
    )
    out = out.withColumn("_ranked", ranked).drop("_sent", "_occ", "_starts")
    kept_type = "array<struct<i:int,s:string>>"
    start = F.struct(
        F.lit(0).cast("bigint").alias("before"), F.array().cast(kept_type).alias("kept")
    )

    def step(acc: Column, s: Column) -> Column:
        fits = (acc["before"] < min_words) & (acc["before"] + s["n"] <= max_words)
        one = F.array(F.struct(s["i"].alias("i"), s["s"].alias("s")))
        return F.struct(
            (acc["before"] + s["n"]).alias("before"),
            F.when(fits, F.concat(acc["kept"], one)).otherwise(acc["kept"]).alias("kept"),
        )

    kept = F.sort_array(F.aggregate(F.col("_ranked"), start, step)["kept"])
    out = out.withColumn("_kept", kept).drop("_ranked")
    text = F.array_join(F.transform(F.col("_kept"), lambda s: s["s"]), " ")
    return (
        out.withColumn("summary", F.when(F.size("_kept") > 0, text))
        .withColumn("summary_sentences", F.size("_kept"))
        .drop("_kept")
    )
