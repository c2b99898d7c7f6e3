"""Rows that share an id are one candidate, by their nearest vector."""

import math

import numpy as np

from webtext.llm.ann import LINES, HIT, SLACK, candidates, lines, nearest, search_block, unit


def brute(rows, query_id, q, k=5):
    q, best = np.array(q), {}
    for i, v in rows:
        v = np.array(v)
        if i != query_id:
            best[i] = max(best.get(i, -2.0), float(v @ q) / math.sqrt(v @ v) / math.sqrt(q @ q))
    return [i for i, _ in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]]


def rows_with_copies():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    near = np.array(rows[0][1])
    rows += [(1000, near.tolist())] * 40 + [(1001, (near + rng.normal(size=8) * 0.05).tolist()) for _ in range(40)]
    return rows


def test_copies_of_an_id_take_one_place(spark):
    rows = rows_with_copies()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, df.where("vec_id < 3")).collect()
    for q in range(3):
        own = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert own == brute(rows, q, rows[q][1])


def test_block_gives_k_ids():
    import pandas as pd

    rows = rows_with_copies()
    queries = pd.DataFrame({"query_id": [0], "vector": [rows[0][1]], "radius": [float("inf")]})
    found = search_block(5)(pd.DataFrame(rows, columns=["vec_id", "embedding"]), queries)
    assert found.vec_id.tolist() == brute(rows, 0, rows[0][1])


def test_stop_counts_ids():
    """Copies within a small part of the radius do not end the search."""
    rows = rows_with_copies()
    ids, u = np.array([i for i, _ in rows]), unit(np.array([v for _, v in rows]))
    a, least = lines(8), math.ceil(LINES * HIT - SLACK * math.sqrt(LINES * HIT * (1 - HIT)))
    projected = u @ a
    order, arrays = np.argsort(projected, axis=0, kind="stable").T.copy(), np.sort(projected, axis=0).T.copy()
    seen = candidates(arrays, order, u[0] @ a, u[0], u, 1.2, least, 5, ids)
    assert len(set(ids[seen].tolist())) > 5
