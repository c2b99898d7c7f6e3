"""Pairs of groups named by blocks: none is lost, and a cluster's are named once."""

import random
from itertools import combinations_with_replacement

from webtext.llm.set_join import RUN, SPARSE, dense_blocks, group_pairs


def test_pairs_of_a_large_cluster_and_of_far_groups(spark):
    rng = random.Random(3)
    held = {sig: set(rng.sample(range(100, 140), rng.randint(25, 40))) for sig in range(300)}
    held |= {sig: {rng.randrange(300) for _ in range(rng.randint(1, 4))} for sig in range(300, 500)}
    held[500] = set(range(0, 300, 3))
    routed = spark.createDataFrame([(sig, g) for sig, gs in held.items() for g in gs], "sig long, g long")
    needed = {p for gs in held.values() for p in combinations_with_replacement(sorted(gs), 2)}
    found = [tuple(r) for r in group_pairs(routed).collect()]
    assert len(found) == len(set(found)) and needed <= set(found)
    runs = [gs for gs in held.values() if len(gs) >= RUN and max(gs) - min(gs) < SPARSE * len(gs)]
    assert all(any(min(gs) <= a and b <= max(gs) for gs in runs) for a, b in set(found) - needed)
    block = dict(tuple(r) for r in dense_blocks(routed).collect())
    assert len({block[g] for g in range(100, 140)}) <= 4


def test_pairs_in_a_cluster_come_from_no_band(spark):
    """Before, each of 200 bands named all 820 pairs of these 40 groups."""
    routed = spark.range(200).selectExpr("id as sig", "explode(sequence(0L, 39L)) as g")
    assert {r.block for r in dense_blocks(routed).collect()} == {0}
    assert group_pairs(routed).count() == 40 * 41 // 2
