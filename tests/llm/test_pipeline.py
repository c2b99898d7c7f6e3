"""The pipeline stage by stage, each judged on its own input."""

import hashlib
import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_repeats import brute as cuts
from tests.llm.test_set_join import brute as joined
from webtext.llm import mixing
from webtext.llm.byte_bpe import read_ranks
from webtext.llm.queries import QUERIES
from webtext.sources.shared import materialize

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF), "test-stage"))
    return [[r.asDict() for r in f.collect()] for f in frames]


def test_columns_and_toxicity(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for rows in stages[:5]:
        assert all(list(r) == COLUMNS for r in rows)
    ids = {r["doc_id"] for r in stages[0]}
    assert {r["doc_id"] for r in stages[1]} <= ids and len(stages[1]) >= 0.8 * len(ids)


def test_one_of_each_group_stays(stages):
    want = {d for d, _, c, _ in joined([(r["doc_id"], r["text"]) for r in stages[1]], 5, 80) if d == c}
    assert {r["doc_id"] for r in stages[2]} == want


def test_repeats_are_cut(stages):
    lost = {}
    for doc_id, start, end, *_ in cuts([(r["doc_id"], r["text"]) for r in stages[2]]):
        lost.setdefault(doc_id, []).append((start, end))
    got = {r["doc_id"]: r for r in stages[3]}
    assert len(got) == len(stages[2])
    for r in stages[2]:
        text = r["text"]
        for start, end in sorted(lost.get(r["doc_id"], []), reverse=True):
            text = text[:start] + text[end:]
        assert got[r["doc_id"]]["text"] == text and got[r["doc_id"]]["n_chars"] == len(text)


def test_mix_takes_what_its_plan_says(spark, stages):
    rows = [tuple(r[c] for c in COLUMNS) for r in stages[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = {r["doc_id"]: len(r["takes"]) for r in mixing.plan(docs, [5.0, 2.0, 1.0]).collect()}
    assert Counter(r["doc_id"] for r in stages[4]) == Counter({d: n for d, n in plan.items() if n})


def test_encoding(stages):
    ranks = {t: i for i, t in enumerate(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in stages[4]}
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        ids = other.encode_ordinary(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_is_the_stages(spark, stages):
    got = QUERIES["pipeline"](spark, SF).collect()
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in got) == Counter((r["doc_id"], r["ids_sha256"]) for r in stages[5])
