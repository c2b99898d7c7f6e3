"""Nearest neighbours and token counts against plain scans."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from webtext.llm.ann import nearest
from webtext.llm.byte_bpe import Vocabulary
from webtext.llm.queries import QUERIES
from webtext.llm.separators import blocks_of_files, flatten, token_counts


def brute(rows, queries, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for qi, q in [g for g in good if g[0] in queries]:
        scored = sorted((-float(v @ q) / math.sqrt(v @ v) / math.sqrt(q @ q), i) for i, v in good if i != qi and len(v) == len(q))
        out[qi] = scored[:k]
    return out


def recall(got, want):
    hit = sum(len({r["vec_id"] for r in got if r["query_id"] == q} & {i for _, i in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


def test_recall_and_scores(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(path).to_pylist()]
    want = brute(rows, {i for i, _ in rows if i % 50 == 0})
    got = QUERIES["op1_ann"](spark, "/root/testdata/sf0.1").collect()
    assert recall(got, want) >= 0.97
    vectors = dict(rows)
    for r in got:
        a, b = np.array(vectors[r["query_id"]], float), np.array(vectors[r["vec_id"]], float)
        assert math.isclose(r["score"], a @ b / math.sqrt(a @ a) / math.sqrt(b @ b), abs_tol=1e-12)
        assert r["vec_id"] != r["query_id"]
    for q in want:
        own = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == [1, 2, 3, 4, 5] and own == sorted(own, key=lambda r: r[1:])


def test_ties_and_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(100)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(100, 200)]
    rows += [(200, None), (250, []), (300, [0.0, 0.0, 0.0]), (350, [1.0, None, 2.0]), (400, [float("nan"), 1.0, 1.0]), (450, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (500, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(df, df.where("vec_id % 50 = 0")).collect()
    by = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50, 100, 150)}
    assert by[0] == [1, 2, 3, 4, 5] and by[50] == [0, 1, 2, 3, 4]
    assert {r["query_id"] for r in got} == {0, 50, 100, 150}
    few = nearest(df.where("vec_id in (1, 100, 101)"), df.where("vec_id = 100")).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 101]
    assert nearest(df.where("false"), df.where("false")).count() == 0


def test_counts_query(spark, sf, docs):
    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {r["doc_id"]: r["n"] for r in docs.select("doc_id", vocabulary.encode("text").alias("i")).selectExpr("doc_id", "octet_length(i) div 4 as n").collect()}
    got = QUERIES["op4_separators"](spark, sf).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(want)


def test_files_with_documents_over_many_blocks(spark, tmp_path):
    rng = np.random.default_rng(4)
    want = {}
    for name in ("a", "b", "c", "empty"):
        lengths = [] if name == "empty" else [0, 0, 50, 1, *rng.integers(0, 30, 40).tolist(), 100]
        ids = [t for n in lengths for t in [*rng.integers(0, 9, n).tolist(), 9]]
        if name == "b":
            ids += [1, 2, 3]
            lengths.append(3)
        if name == "c":
            ids, lengths = [1] * 64, [64]
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, "<u4").tobytes())
        want[name] = lengths
    for block in (8, 64):
        got = token_counts(blocks_of_files(spark, f"{tmp_path}/*.bin", "<u4", block), 9, "<u4", block).collect()
        for name, lengths in want.items():
            own = sorted((r["ordinal"], r["start"], r["n_tokens"], r["closed"]) for r in got if r["stream"].endswith(f"/{name}.bin"))
            assert [r[2] for r in own] == lengths and [r[0] for r in own] == list(range(len(own)))
            starts = np.cumsum([0, *[n + 1 for n in lengths]])[: len(own)]
            assert [r[1] for r in own] == starts.tolist()
            assert [r[3] for r in own] == [not (name == "c" or (name == "b" and i == len(own) - 1)) for i in range(len(own))]


def test_odd_rows(odd, no_docs):
    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for df, block in ((odd, 64), (odd, 4), (no_docs, 8)):
        ids = df.select("doc_id", vocabulary.encode("text").alias("ids"))
        want = sorted(((r["doc_id"], len(r["ids"]) // 4) for r in ids.collect()), key=str)
        got = token_counts(flatten(ids, "ids", 50256, block), 50256, "<u2", block, label="closed").collect()
        assert sorted(((r["label"], r["n_tokens"]) for r in got), key=str) == want


def test_ids_beyond_two_bytes_are_refused(spark):
    df = spark.createDataFrame([(1, (70_000).to_bytes(4, "little"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="70000"):
        flatten(df, "ids", 5).count()
