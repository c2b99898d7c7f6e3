"""Registered queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.llm import sql as SQL_TEXTS
from webtext.llm.common import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ROOT = str(Path(__file__).resolve().parents[2])


def register(name: str, sql: str | None = None):
    def add(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Workers of this session import the operators from the same place as the driver.
            paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
            if ROOT not in paths.split(os.pathsep):
                spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, paths]))
            small_batches(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op5_byte_bpe")
def op5(spark, d):
    import public_tokenizers

    from webtext.llm.byte_bpe import Vocabulary, round_trip

    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = round_trip(table(spark, d, "documents").select("doc_id", "text"), vocabulary)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@register("op8_sharding")
def op8(spark, d):
    from webtext.llm.sharding import assign, number_in_shards

    docs = table(spark, d, "documents").select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign(docs, "doc_id", [1.0] * 40)
    return number_in_shards(placed, "doc_id", "text_crc32", "size")


MIX_WEIGHTS = [5.0, 2.0, 1.0]


@register("op2_mixing")
def op2(spark, d):
    from webtext.llm.mixing import in_order, plan

    rows = in_order(plan(table(spark, d, "documents"), MIX_WEIGHTS))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "position", "positions")


@register("op6_fingerprints")
def op6(spark, d):
    from webtext.llm.fingerprints import with_next

    return with_next(table(spark, d, "documents"))


@register("op7_set_join", SQL_TEXTS.OP7)
def op7(spark, d):
    from webtext.llm.set_join import jaccard_components

    return jaccard_components(table(spark, d, "documents"), width=3, percent=90)


@register("op3_repeats")
def op3(spark, d):
    from webtext.llm.repeats import repeated

    return repeated(table(spark, d, "documents")).drop("th")


@register("op9_toxicity")
def op9(spark, d):
    from webtext.llm.toxicity import fold, train

    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = train(docs, table(spark, d, "labels")).score(docs)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@register("op1_ann")
def op1(spark, d):
    from webtext.llm.ann import nearest

    vectors = table(spark, d, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))


END_OF_DOCUMENT = 50256


@register("op4_separators")
def op4(spark, d):
    import public_tokenizers

    from webtext.llm.byte_bpe import Vocabulary
    from webtext.llm.separators import flatten, token_counts

    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, d, "documents").select("doc_id", vocabulary.encode("text").alias("ids"))
    blocks = flatten(docs, "ids", END_OF_DOCUMENT)
    found = token_counts(blocks, END_OF_DOCUMENT, "<u2", label="closed")
    return found.select(F.col("label").alias("doc_id"), "stream", "ordinal", "start", "n_tokens")


@register("op10_context_mixing")
def op10(spark, d):
    from webtext.llm.context_mixing import score

    return score(table(spark, d, "documents"))


@register("op11_flat_graph", SQL_TEXTS.OP11)
def op11(spark, d):
    from webtext.llm.flat_graph import near_vectors

    return near_vectors(table(spark, d, "embeddings")).drop("recall")


@register("op12_conversation_trie", SQL_TEXTS.OP12)
def op12(spark, d):
    from webtext.llm.conversation_trie import digest_turns, grafted, prefix_trie
    from webtext.sources.shared import materialize

    turns = materialize(digest_turns(table(spark, d, "conversations")), "turns")
    ids = turns.select("conv_id").distinct()
    return prefix_trie(materialize(grafted(turns, ids), "grafted"), ids).drop("key", "parent")


@register("op13_fill_in_middle", SQL_TEXTS.OP13)
def op13(spark, d):
    from webtext.llm.fill_in_middle import fill_in_middle, restored

    made = fill_in_middle(table(spark, d, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


@register("pipeline")
def pipeline(spark, d):
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)
