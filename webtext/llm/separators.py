"""Token counts of flat, unindexed token files by a scan for separators.

A flat file is one run of token ids in which an end-of-document id closes each document.
Files are read as blocks of a fixed number of tokens. Each block is searched for the
separator in one vectorised comparison; where a document spans blocks, a prefix scan
carries the place of the last separator from block to block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.llm.common import prefix_sums
from webtext.sources.shared import materialize, work_dir

BLOCK = 1 << 16
WIDTHS = {"<u2": 2, "<u4": 4}


def blocks_of_files(spark: SparkSession, path: str, kind: str = "<u4", block: int = BLOCK) -> DataFrame:
    """``stream, block, payload`` of binary files of ids (little-endian, 2 or 4 bytes).

    A file is read by one task, as Spark's binary source does; keep files below 2 GB.
    """
    step = block * WIDTHS[kind]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, data in zip(*[c.to_pylist() for c in part.columns]):
                for i in range(0, len(data), step * 64):
                    cut = [data[j : j + step] for j in range(i, min(i + step * 64, len(data)), step)]
                    first = i // step
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut)), pa.array(range(first, first + len(cut)), pa.int64()), pa.array(cut, pa.binary())], ["stream", "block", "payload"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "stream string, block long, payload binary")


def flatten(docs: DataFrame, ids: str, eod: int, block: int = BLOCK) -> DataFrame:
    """Flat streams of 2-byte ids, one per task, written once: ``stream, block, payload``,
    and ``closed``, the ids of the documents that end in the block (for checks only)."""
    schema = pa.schema([("stream", pa.string()), ("block", pa.int64()), ("payload", pa.binary()), ("closed", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, number, held, closed = f"{TaskContext.get().partitionId():06d}", 0, np.empty(0, "<u2"), []
        row = lambda data, names: pa.RecordBatch.from_arrays([pa.array([stream]), pa.array([number], pa.int64()), pa.array([data.tobytes()], pa.binary()), pa.array([names], pa.list_(pa.int64()))], schema=schema)
        for part in parts:
            for doc_id, packed in zip(*[c.to_pylist() for c in part.columns]):
                tokens = np.frombuffer(packed or b"", "<u4")
                if len(tokens) and tokens.max() > 0xFFFF:
                    raise ValueError(f"id {tokens.max()} does not fit the 2 bytes of a flat stream")
                held = np.concatenate([held, tokens.astype("<u2"), np.array([eod], "<u2")])
                end = len(held) - 1
                while len(held) >= block:
                    here = closed
                    if end < block:
                        here, closed = [*closed, doc_id], []
                        end = -1
                    else:
                        end, closed = end - block, []
                    yield row(held[:block], here)
                    held, number = held[block:], number + 1
                if end >= 0:
                    closed.append(doc_id)
        if len(held):
            yield row(held, closed)

    out = docs.select(F.col("doc_id").cast("long"), ids).mapInArrow(run, "stream string, block long, payload binary, closed array<long>")
    path = work_dir(docs.sparkSession, "flat")
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def places(payload: str | Column, eod: int, kind: str) -> Column:
    """Places of the separator in a block."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            found = [np.flatnonzero(np.frombuffer(x.as_py() or b"", kind) == eod) for x in part]
            yield pa.array(found, pa.list_(pa.int64()))

    return F.arrow_udf(run, "array<long>")(payload)


def token_counts(blocks: DataFrame, eod: int, kind: str = "<u4", block: int = BLOCK, label: str | None = None) -> DataFrame:
    """``stream, ordinal, start, n_tokens, closed`` of each document, separators excluded,
    and ``label``: the entry of that array column for the separator in its block.

    ``start`` is the place of a document's first token in its stream, ``ordinal`` its
    number from 0. Tokens after the last separator are a document with ``closed`` false.
    Two separators in a row enclose an empty document; an empty stream has none. Every
    block but the last of a stream must hold ``block`` tokens. A payload is read once;
    the scan over blocks handles one short row per block, in parts.
    """
    labels = [F.col(label).alias("labels")] if label else []
    seen = materialize(
        blocks.select("stream", "block", *labels, F.expr(f"octet_length(payload) div {WIDTHS[kind]}").cast("long").alias("n"), places("payload", eod, kind).alias("ends")),
        "separators",
    )
    base = F.col("block") * block
    rows = seen.withColumn("last", base + F.try_element_at("ends", F.lit(-1))).withColumn("closes", F.size("ends").cast("long"))
    rows = prefix_sums(rows.select("stream", "block", "closes", "last"), ["stream"], ["block"], most={"before": "last"}, ordinal="closes")
    rows = seen.join(rows.select("stream", "block", "before", "ordinal"), ["stream", "block"])
    absolute = rows.withColumn("ends", F.transform("ends", lambda e: e + base)).withColumn("before", F.coalesce("before", F.lit(-1).cast("long")))
    first = lambda i: F.coalesce(F.get("ends", i - 1), F.col("before")) + 1
    entry = F.transform(
        "ends",
        lambda e, i: F.struct(
            (F.col("ordinal") + i).alias("ordinal"), first(i).alias("start"), (e - first(i)).alias("n_tokens"), F.lit(True).alias("closed"),
            *([F.get("labels", i).alias("label")] if label else []),
        ),
    )
    whole = absolute.select("stream", F.inline(entry))
    rest = seen.groupBy("stream").agg(
        F.sum(F.size("ends")).cast("long").alias("ordinal"),
        (F.coalesce(F.max(base + F.try_element_at("ends", F.lit(-1))), F.lit(-1).cast("long")) + 1).alias("start"),
        F.max(base + F.col("n")).alias("_end"),
    )
    rest = rest.where("_end > start").select("stream", "ordinal", "start", (F.col("_end") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return whole.unionByName(rest, allowMissingColumns=True)
