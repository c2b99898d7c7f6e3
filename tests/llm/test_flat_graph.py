"""Links and components of near vectors against all pairs, and the graph alone."""

import numpy as np

from webtext.llm import flat_graph
from webtext.llm.queries import QUERIES, SQL

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, n int, shard double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "clash", 1, 2.0) for i, v, l in rows], SCHEMA)


def brute(rows, least=0.98):
    """``{vec_id: (n_links, component)}`` by all pairs of usable vectors."""
    use = [(i, np.array(v, np.float32).astype(float), l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, _, _ in rows if i is not None}
    for a, x, l in use:
        for b, y, m in use:
            if a != b and l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[a].add(b)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def family(rng, n, dim, spread, center=None):
    center = rng.standard_normal(dim) if center is None else center
    center = center / np.linalg.norm(center)
    return [(center + spread * rng.standard_normal(dim) / np.sqrt(dim)).tolist() for _ in range(n)]


def sample(seed=1, dim=16):
    """Loners, pairs, chains and a large family per label, with copies."""
    rng = np.random.default_rng(seed)
    vectors = []
    for label in range(3):
        own = rng.standard_normal((90, dim)).tolist()
        own += family(rng, 60, dim, 0.12) + family(rng, 25, dim, 0.3)
        for _ in range(15):
            own += family(rng, 2, dim, 0.1)
        a, b = rng.standard_normal((2, dim))
        own += [(np.cos(t) * a / np.linalg.norm(a) + np.sin(t) * b / np.linalg.norm(b)).tolist() for t in np.arange(0, 1.5, 0.15)]
        own += [own[0]] * 20 + [own[95]] * 3
        vectors += [(v, label) for v in own]
    order = rng.permutation(len(vectors))
    return [(int(i), *vectors[i]) for i in order]


def compare(got, rows):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == want[r.vec_id]
        assert r.kept == (r.vec_id == r.component_id)


def test_shards_find_links(spark):
    """One shard has all links; families larger than a shard keep nine tenths at least, and
    the audit's figure makes the search widen until more are found."""
    rows = sample()
    true = sum(n for n, _ in brute(rows).values())
    compare(flat_graph.near_vectors(frame(spark, rows)).collect(), rows)
    for shard, least_recall, share in ((60, 0.0, 0.95), (30, 0.0, 0.9), (30, 0.97, 0.96)):
        got = flat_graph.near_vectors(frame(spark, rows), least_recall=least_recall, shard=shard).collect()
        found = sum(r.n_links for r in got) / true
        assert found >= share, (shard, found)
        assert abs(got[0].recall - found) < 0.1


def test_nothing_false_and_last_resort(spark):
    rows = sample(2)
    want = brute(rows)
    for r in flat_graph.near_vectors(frame(spark, rows), least_recall=0.0, shard=200).collect():
        assert r.n_links <= want[r.vec_id][0] and r.component_id >= want[r.vec_id][1]
    # A recall that no search reaches leads to blocks.
    got = flat_graph.near_vectors(frame(spark, rows), least_recall=2.0, shard=200).collect()
    compare(got, rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1),
        (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.1], 1), (14, [-1.0, 0.0], 1),
    ]
    compare(flat_graph.near_vectors(frame(spark, rows)).collect(), rows)
    twice = flat_graph.near_vectors(frame(spark, [*rows, *rows, (None, [1.0, 0.0], 1)])).collect()
    assert len(twice) == len(rows) + 1
    compare([r for r in twice if r.vec_id is not None], rows)
    lost = next(r for r in twice if r.vec_id is None)
    assert (lost.n_links, lost.component_id, lost.kept) == (0, None, True)
    assert flat_graph.near_vectors(frame(spark, [])).count() == 0


def test_query_equals_sql(spark, sf, duck):
    got, want = QUERIES["op11_flat_graph"](spark, sf), duck.sql(SQL["op11_flat_graph"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_search_reaches_from_medoids():
    """On one graph the beam finds most vectors without starting at their own node."""
    rng = np.random.default_rng(4)
    u = flat_graph.unit(np.array([v for _ in range(40) for v in family(rng, 20, 24, 0.5)]))
    graph = flat_graph.pruned(u)
    starts = flat_graph.medoids(u, np.arange(len(u)))
    reached = 0
    for i in range(0, len(u), 10):
        copy = np.vstack([u, u[i]])
        lone = np.vstack([graph, np.full(graph.shape[1], -1)])
        reached += i in flat_graph.in_range(len(u), copy, lone, starts, 0.98, flat_graph.BEAM)
    assert reached >= 0.9 * 80
