"""Training positions: the order of the query's rows against schedules inverted numerically."""

import numpy as np

from webtext.llm.mixing import SCHEDULES, in_order, plan
from webtext.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def words_by(time, rates, target, steps=20_000):
    """Words a source has been asked for by ``time``: its rate summed in small steps."""
    at = (np.arange(steps) + 0.5) / steps
    rate = rates[0] + (rates[1] - rates[0]) * at
    return target * rate[at < time].sum() / rate.sum()


def test_rows_come_in_training_order_and_positions_invert_the_schedules(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()}
    rows = QUERIES["op2_mixing"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    order = [(r.position is None, r.position or 0.0, r.doc_id) for r in rows]
    assert [o[:2] for o in order] == sorted(o[:2] for o in order)
    assert all((r.position is None) == (r.taken == 0) and (r.positions or [None])[0] == r.position for r in rows)
    names = sorted({d.source for d in docs.values()}, key=lambda s: (s is None, s))
    for i, source in enumerate(names):
        own = [r for r in rows if docs[r.doc_id].source == source]
        first, target = [r for r in own if r.taken], own[0].target
        # In training order, each first epoch begins where the words of those before it end.
        begins = np.cumsum([0] + [r.size for r in first])[:-1]
        for begin, r in list(zip(begins, first))[:: max(1, len(first) // 40)]:
            assert abs(words_by(r.position, SCHEDULES[i % 3], target) - begin) < max(2.0, target / 5_000)
        second = sorted((r for r in own if len(r.positions) > 1), key=lambda r: r.positions[1])
        begins = own[0].source_size + np.cumsum([0] + [r.size for r in second])[:-1]
        for begin, r in list(zip(begins, second))[:: max(1, len(second) // 40)]:
            assert abs(words_by(r.positions[1], SCHEDULES[i % 3], target) - begin) < max(2.0, target / 5_000)


def test_odd_rows(odd, no_docs):
    rows = in_order(plan(odd, [5.0, 2.0, 1.0])).collect()
    assert len(rows) == odd.count()
    assert [r.position is None for r in rows] == sorted(r.position is None for r in rows)
    assert all(r.position is None and r.positions == [] for r in rows if not r.taken)
    assert in_order(plan(no_docs, [5.0, 2.0, 1.0])).count() == 0
