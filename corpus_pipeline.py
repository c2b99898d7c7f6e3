"""The corpus pipeline: five stages over ``documents``, each written and read again.

Toxic documents go; of each group of near duplicates (five-word shingles, similarity 0.8)
one document stays; repeated passages are cut; sources are mixed to target weights, in
training order; texts are encoded and decoded.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.llm import mixing, queries, repeats, set_join, toxicity
from webtext.llm.byte_bpe import Vocabulary, round_trip
from webtext.llm.common import small_batches
from webtext.sources.shared import materialize, remove_work, work_listed

LEFT: list[str] = []


def stage(call):
    """A stage with bounded batches. Work folders of the stage before, whose rows have been
    written by now, are removed first; those of the last stage stay."""

    @functools.wraps(call)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        remove_work(spark, LEFT)
        with work_listed() as made:
            rows = call(spark, docs, sf_dir)
        LEFT[:] = made
        return rows

    return run


@stage
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5. Trees learn from the labels of ``sf_dir`` (see ``toxicity``)."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates."""
    return set_join.keep_one(docs, width=5, percent=80)


@stage
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that came in an earlier document or earlier in the same."""
    return repeats.without_repeats(docs).select(*docs.columns)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once per epoch that takes them: sources share 150% of
    all words by weights 5, 2, 1, up to twice their size."""
    return mixing.mixed(docs, queries.MIX_WEIGHTS)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids, ids_sha256, decoded_sha256`` of each row."""
    import public_tokenizers

    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = round_trip(docs.select("doc_id", "source", "text"), vocabulary)
    return rows.select(
        "doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", toxic),
    ("near duplicates", near_duplicates),
    ("passages", passages),
    ("mix", mix),
    ("encode", encode),
]
# Trees, minhashes and merges of a tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result of the last stage. Each stage's rows are written once, so a lost executor
    costs tasks of one stage only."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = materialize(step(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
