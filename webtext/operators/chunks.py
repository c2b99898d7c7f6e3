"""Chunk and segment tables, and putting them back together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import text as T


def chunk_words(docs: DataFrame, size: int = T.CHUNK_WORDS) -> DataFrame:
    """``document_id, chunk_idx, chunk``; a document without words has none."""
    return docs.select(
        "document_id", F.posexplode(T.chunks(F.col("text"), size)).alias("chunk_idx", "chunk")
    )


def speech_segments(docs: DataFrame) -> DataFrame:
    """``document_id, seg_idx, seg_name, text``."""
    found = docs.select("document_id", F.posexplode(T.segments(F.col("text"))).alias("seg_idx", "text"))
    return found.select("document_id", "seg_idx", T.segment_name(F.col("seg_idx")).alias("seg_name"), "text")


def rejoin(
    pieces: DataFrame, key: str, position: str, value: Column | str, name: str, part_size: int | None = None
) -> DataFrame:
    """``key, name, pieces``: values joined by newlines in their order.

    Pieces cut from one row make a group no larger than that row. For pieces that came
    as rows of their own, so that a key may have any number of them, ``part_size`` adds
    ``part``: a key with more positions (counted from 0) gives several parts, which
    joined in order are the whole text, and no task gathers an unbounded group.
    """
    value = F.col(value) if isinstance(value, str) else value
    keys = [F.col(key)]
    if part_size:
        keys.append(F.expr(f"cast({position} as bigint) div {part_size}").alias("part"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), value.alias("v"))))
    return pieces.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda x: x["v"]), "\n").alias(name),
        F.count("*").alias("pieces"),
    )


def speech_playlist(docs: DataFrame) -> DataFrame:
    """``document_id, playlist, pieces``: ordered segment names of every track, made in the
    document's own row; a document without segments has none."""
    counted = docs.select("document_id", F.size(T.segments(F.col("text"))).cast("long").alias("pieces")).where("pieces > 0")
    names = F.transform(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1), T.segment_name)
    return counted.select("document_id", F.array_join(names, "\n").alias("playlist"), "pieces")
