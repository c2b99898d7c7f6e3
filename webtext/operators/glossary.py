"""Glossary translation with the glossary as a table of any size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webtext.functions import text as T
from webtext.operators.chunks import chunk_words, rejoin
from webtext.sources.shared import materialize

# Chunks that share one look at the glossary.
PACK = 256


def pack_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each pack of ``pack, chunk``; rows of a pack come one after another."""
    now, held = None, set()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now] * len(held), pa.int64()), pa.array(held, pa.string())], ["pack", "word"])

    for part in parts:
        for pack, chunk in zip(*[c.to_pylist() for c in part.columns]):
            if pack != now and held:
                yield flush()
                held = set()
            now = pack
            held.update(chunk.split(" "))
    if held:
        yield flush()


def translated(chunks: pa.Table, entries: pa.Table) -> pa.Table:
    """``document_id, chunk_idx, line`` of a pack; for chunks named by ``row`` in ``entries``
    the words with their places instead of the line."""
    words, found, rows = [entries.column(c).to_pylist() for c in ("word", "translations", "row")]
    known = {w: t for w, t in zip(words, found) if w is not None}
    joined = {w: " ".join(t) for w, t in known.items()}
    again = set(rows)
    lines, placed = [], []
    for row, chunk in zip(chunks.column("row").to_pylist(), chunks.column("chunk").to_pylist()):
        own = chunk.split(" ")
        split = row in again
        lines.append(None if split else " ".join([joined.get(w, w) for w in own]))
        placed.append([{"pos": i, "w": t} for i, w in enumerate(own) for t in known.get(w, (w,))] if split else None)
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("w", pa.string())]))
    return chunks.select(["document_id", "chunk_idx"]).append_column("line", pa.array(lines, pa.string())).append_column("words", pa.array(placed, kind))


def translate_with_table(docs: DataFrame, glossary: DataFrame, size: int = T.CHUNK_WORDS) -> DataFrame:
    """``document_id, text, pieces`` for ``document_id, text``; blank texts have no row.

    ``glossary`` has one row per ``word`` with its ``translation``. Chunks are written once and
    taken in packs of ``PACK``. Each distinct word of a pack is joined with the glossary, not
    each word of the texts, and the pack's entries meet its chunks; so texts are shuffled as
    they are, and a very frequent word is one row a pack. Chunks of rows that share an id are
    merged word by word, by place and then word; a word with several rows in the glossary is
    replaced by all its translations in order.
    """
    cut = chunk_words(docs, size).withColumn("row", F.monotonically_increasing_id())
    cut = materialize(cut, "chunks").withColumn("pack", F.expr(f"row div {PACK}"))
    words = cut.select("pack", "chunk").mapInArrow(pack_words, "pack long, word string")
    meanings = glossary.groupBy("word").agg(F.sort_array(F.collect_list(F.coalesce("translation", "word"))).alias("translations"))
    entries = words.join(meanings, "word").select("pack", "word", "translations", F.lit(None).cast("long").alias("row"))
    same = F.count("*").over(Window.partitionBy("document_id", "chunk_idx"))
    again = cut.select("pack", "row", same.alias("n")).where("n > 1")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("word", "string"), ("translations", "array<string>"))]
    entries = entries.unionByName(again.select("pack", *none, "row"))

    key = cut.schema["document_id"].dataType.simpleString()
    done = cut.groupBy("pack").cogroup(entries.groupBy("pack")).applyInArrow(
        translated, f"document_id {key}, chunk_idx int, line string, words array<struct<pos:int,w:string>>"
    )
    merged = F.array_join(F.transform(F.array_sort(F.flatten(F.collect_list("words"))), lambda x: x["w"]), " ")
    lines = done.repartition("document_id").groupBy("document_id", "chunk_idx").agg(F.coalesce(F.max("line"), merged).alias("line"))
    return rejoin(lines, "document_id", "chunk_idx", "line", "text")
