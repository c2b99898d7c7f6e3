"""The Jaccard join and its components against all pairs compared one by one."""

import random
from collections import defaultdict
from itertools import combinations

import pytest

from webtext.llm.components import components
from webtext.llm.queries import QUERIES
from webtext.llm.set_join import jaccard_components, keep_one


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    """doc -> (n_shingles, component id, links) of rows ``(doc_id, text)``."""
    sets = [shingles(t, width) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    name = {r: min((d for d in ds if d is not None), default=None) for r, ds in least.items()}
    return sorted(((d, len(s), name[find(i)], links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_equals_brute_force(spark, sf, docs, width, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = QUERIES["op7_set_join"](spark, sf) if percent == 90 else jaccard_components(docs, width, percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, width, percent)


def test_hot_group_of_variants(spark):
    """Variants of one text at all distances, next to copies and unrelated texts."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(k, " ".join(base)) for k in range(40)]
    for k in range(40, 240):
        words = list(base)
        for _ in range(rng.randint(1, 8)):
            words[rng.randrange(150)] = f"x{rng.randrange(60)}"
        rows.append((k, " ".join(words)))
    rows += [(k, " ".join(f"z{rng.randrange(10**6)}" for _ in range(60))) for k in range(240, 280)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(df, 3, 90).collect()), key=str) == brute(rows, 3, 90)


def test_odd_rows(odd, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, jaccard_components(odd, 3, 90).collect()), key=str) == brute(rows, 3, 90)
    assert jaccard_components(no_docs, 3, 90).count() == 0
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 3, 4, None, 5, 6, 7, 8]))


def test_one_text_stays_of_rows_without_or_with_one_id(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, "quite another text here now"), (None, long), (None, long + " x"), (5, long + " x y"), (7, "p q r s t u"), (7, "some other words of id seven")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(1, "a b c d e f"), (None, "quite another text here now"), (5, long + " x y"), (7, "p q r s t u"), (7, "some other words of id seven")]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))
    nameless = keep_one(spark.createDataFrame([(None, long), (None, long + " x"), (None, "")], "doc_id long, text string"))
    assert nameless.count() == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
