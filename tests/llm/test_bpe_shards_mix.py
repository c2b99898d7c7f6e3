"""Byte-level BPE, sharding and mixing against other implementations and small rules."""

import hashlib
import math
import struct
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
import xxhash

from webtext.llm import mixing, sharding
from webtext.llm.byte_bpe import Vocabulary, read_ranks, round_trip
from webtext.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def other():
    ranks = {t: i for i, t in enumerate(read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_ids(rows, other):
    for r in rows:
        ids = other.encode_ordinary(r.text or "")
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids
        assert r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r.text or "").encode()


def test_bpe_equals_tiktoken(docs, odd, no_docs, other):
    vocabulary = Vocabulary(PATH, public_tokenizers.PATTERN)
    check_ids(round_trip(docs, vocabulary).collect(), other)
    check_ids(round_trip(odd, vocabulary).collect(), other)
    assert round_trip(no_docs, vocabulary).count() == 0


def test_bpe_query(spark, sf, docs, other):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = QUERIES["op5_byte_bpe"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = other.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def shard_of(key, weights):
    def cost(i, w):
        seed = 42
        for v in (key, i):
            if v is not None:
                seed = xxhash.xxh64(struct.pack("<q", v), seed=seed).intdigest()
        return -math.log(((seed >> 12) + 0.5) / 2**52) / w

    return min((cost(i, w), i) for i, w in enumerate(weights) if w > 0)[1]


def test_shards(spark, sf, odd, no_docs):
    got = QUERIES["op8_sharding"](spark, sf).collect()
    slots = defaultdict(list)
    for r in got:
        assert r.shard == shard_of(r.doc_id, [1.0] * 40)
        assert r.grown_shard == shard_of(r.doc_id, [1.0] * 41)
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rows = sharding.number_in_shards(sharding.assign(odd, "doc_id", [1.0, 0.0, 2.5]), "doc_id").collect()
    assert len(rows) == odd.count() and {r["shard"] for r in rows} <= {0, 2}
    assert len({r["shard"] for r in rows if r["doc_id"] == 2}) == 1
    assert sharding.number_in_shards(sharding.assign(no_docs, "doc_id", [1.0])).count() == 0


def test_shard_weights(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = {r["shard"]: r["count"] for r in sharding.assign(df, "doc_id", [1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(counts[1] / 20_000 - 0.75) < 0.02


def water(sizes, weights, share, most):
    """Targets by sharing the excess again until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = rest - sum(full.values())
        got = {s: left * w[s] / sum(w[t] for t in free) for s in free}
        over = [s for s in free if got[s] > most * sizes[s]]
        if not over:
            return full | got
        full |= {s: most * sizes[s] for s in over}


def test_mix_targets_and_takes(spark, sf, docs, odd, no_docs):
    for df in (docs, odd):
        sizes, taken = defaultdict(int), defaultdict(int)
        rows = mixing.plan(df, [5.0, 2.0, 1.0]).collect()
        assert len(rows) == df.count()
        for r in rows:
            sizes[r["source"]] += r["size"]
            taken[r["source"]] += r["taken"]
            assert 0 <= r["taken"] <= 2 * r["size"]
            assert all(0 <= t["position"] <= 1 for t in r["takes"])
        want = water(sizes, [5.0, 2.0, 1.0], 1.5, 2.0)
        for r in rows:
            assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
            assert r["source_size"] == sizes[r["source"]]
        for s in sizes:
            assert abs(taken[s] - want[s]) <= 1
    again = QUERIES["op2_mixing"](spark, sf).orderBy("doc_id").collect()
    assert again == QUERIES["op2_mixing"](spark, sf).orderBy("doc_id").collect()
    assert mixing.plan(no_docs, [1.0]).count() == 0


def test_mixed_rows_in_order(docs, odd, no_docs):
    for df in (docs, odd):
        times = [(t["position"], r["doc_id"]) for r in mixing.plan(df, [5.0, 2.0, 1.0]).collect() for t in r["takes"]]
        out = mixing.mixed(df, [5.0, 2.0, 1.0])
        assert out.columns == df.columns
        got = [r["doc_id"] for r in out.collect()]
        assert sorted(map(str, got)) == sorted(str(d) for _, d in times)
        if df is docs:
            assert got == [d for _, d in sorted(times)]
    assert mixing.mixed(no_docs, [1.0]).count() == 0


def test_schedule_moves_words(docs):
    """A falling schedule trains on more of its words in the first half."""
    takes = [(r["source"], t["position"], t["words"]) for r in mixing.plan(docs, [1.0], schedules=((1.5, 0.5),)).collect() for t in r["takes"]]
    early = sum(w for _, p, w in takes if p < 0.5) / sum(w for _, _, w in takes)
    assert abs(early - 0.625) < 0.08
