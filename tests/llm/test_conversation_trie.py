"""The trie against one built turn by turn in a dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from webtext.llm import conversation_trie as trie
from webtext.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


def rebuilt(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    return out


def brute(convs):
    """Rows of the contract for ``{conv_id: turns}``."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def rows_of(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def run(spark, rows, segment=None):
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA)
    turns = trie.digest_turns(df)
    ids = turns.select("conv_id").distinct()
    return rows_of(trie.prefix_trie(trie.grafted(turns, ids), ids, segment))


def forest(seed):
    """Conversations that branch off each other, with copies, very long ones and gaps."""
    rng = random.Random(seed)
    convs = {}
    for c in range(0, 160, 1 + seed):
        if convs and rng.random() < 0.7:
            start = rng.choice(list(convs.values()))
            turns = start[: rng.randint(0, len(start))]
        else:
            turns = []
        convs[c] = turns + [(rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d e f"])) for _ in range(rng.choice([0, 1, 3, 12]))]
    convs |= {1001: convs[0] + [("user", "x y")] * 40, 1003: convs[0] + [("user", "x y")] * 40}
    return [(c, t, role, text) for c, ts in convs.items() for t, (role, text) in enumerate(ts)]


def test_blocks_and_segments(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 3)
    for seed, segment, block in ((0, 4, 7), (1, 3, 16384), (2, None, 5)):
        monkeypatch.setattr(trie, "BLOCK", block)
        rows = forest(seed)
        assert run(spark, rows, segment) == brute(rebuilt(rows))


def test_copies_odd_rows_and_empty(spark):
    rows = [(c, t, "system", f"same {t}") for c in range(0, 400) for t in range(3)]
    rows += [(7, None, None, None), (7, None, None, None), (None, 1, "user", "lost"), (900, 5, "user", "late"), (900, 1, "user", "word " * 50_000)]
    assert run(spark, rows) == brute(rebuilt(rows))
    # A lone short conversation whose base is absent has no turns: the root is all there is.
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert run(spark, [(alone, 0, "user", "x")]) == brute({alone: []})
    assert run(spark, []) == []


def test_query_equals_sql_and_loop(spark, sf, duck):
    got = QUERIES["op12_conversation_trie"](spark, sf)
    want = duck.sql(SQL["op12_conversation_trie"])
    assert got.columns == want.columns
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    exact = brute(rebuilt([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))
    assert rows_of(got) == exact
    assert sorted(tuple(-1 if v is None else v for v in r) for r in want.fetchall()) == exact


def test_sparse_table_searches():
    lcp = np.random.default_rng(3).integers(-1, 6, 60)
    levels = trie.tables(lcp, np.minimum)
    rows = np.repeat(np.arange(61), 7)
    depths = np.tile(np.arange(7), 61)
    left, right = trie.left_ends(levels, rows, depths), trie.right_ends(levels, rows, depths)
    for r, d, a, b in zip(rows, depths, left, right):
        want_b = next((i for i in range(r, 60) if lcp[i] < d), 60)
        want_a = next((i + 1 for i in range(r - 1, -1, -1) if lcp[i] < d), 0)
        assert (a, b) == (want_a, want_b)
    least = trie.range_min(levels, np.arange(30), np.arange(30) * 2)
    assert least.tolist() == [lcp[i : 2 * i + 1].min() for i in range(30)]
