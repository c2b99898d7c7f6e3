"""Collisions counted by places are those read from the sorted arrays."""

import numpy as np

from webtext.llm import ann


def test_places_and_ends_give_the_same_candidates(monkeypatch):
    rng = np.random.default_rng(5)
    u = ann.unit(rng.standard_normal((900, 24)))
    projected = u @ ann.lines(24)
    order = np.argsort(projected, axis=0, kind="stable").T.copy()
    arrays = np.sort(projected, axis=0).T.copy()
    block = ann.Arrays(arrays, order)
    for q in range(20):
        radius = float(rng.uniform(0.3, 1.3))
        left, right = block.windows(projected[q : q + 1], np.array([radius]))
        plain = [np.bincount(np.concatenate([order[i, l[0, i] : r[0, i]] for i in range(ann.LINES)]), minlength=900) for l, r in zip(left, right)]
        assert all((block.collisions(l[0], r[0]) == n).all() for l, r, n in zip(left, right, plain))
        found = []
        for read in (0, 16, 10**9):
            monkeypatch.setattr(ann, "READ", read)
            found.append(ann.collected(block, left[:, 0], right[:, 0], u @ u[q], radius, 32, 5).tolist())
        assert found[0] == found[1] == found[2]
