"""Toxicity: held-out accuracy, folds, and awkward rows."""

import zlib

import pytest

from webtext.llm.queries import QUERIES, table
from webtext.llm.toxicity import FEATURES, Codes, Model, features_of, train, without_toxic

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in QUERIES["op9_toxicity"](spark, SF).collect()}


def test_held_out_accuracy(spark, scored):
    assert len(scored) == table(spark, SF, "documents").count()
    pairs = []
    for r in table(spark, SF, "labels").collect():
        s = scored[r.doc_id]
        assert s["held_out"] == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= s["score"] <= 1 and s["predicted"] == int(s["score"] >= 0.5)
        if s["held_out"]:
            pairs.append((s["score"], r.toxic))
    wins = [(a > b) + (a == b) / 2 for a, x in pairs if x for b, y in pairs if not y]
    assert sum(wins) / len(wins) > 0.95
    assert sum((s >= 0.5) == bool(t) for s, t in pairs) / len(pairs) > 0.95


def test_held_out_labels_change_nothing(spark, scored):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    from webtext.llm.toxicity import fold

    turned = labels.withColumn("toxic", (1 - labels.toxic).cast("int")).where(fold("doc_id") == 0).unionByName(labels.where(fold("doc_id") != 0))
    again = {r["doc_id"]: r["toxicity"] for r in train(docs, turned).score(docs).collect()}
    assert again == {k: r["score"] for k, r in scored.items()}


def test_features():
    codes = Codes(frozenset(["idiot", "^vequ"]))
    got = dict(zip(FEATURES, features_of("You are an 1d!ot . VEQUOI so calm today, my good friend", codes)))
    assert got["word_hits"] == pytest.approx(1 / 12) and got["start_hits"] == pytest.approx(1 / 12)
    assert got["disguised_hits"] > 0 and got["near_second_person"] == pytest.approx(1 / 12)
    assert features_of(None, codes) == features_of(" \n", codes) == [0.0] * len(FEATURES)


def test_odd_rows(spark, odd, no_docs):
    labels = table(spark, SF, "labels")
    model = train(table(spark, SF, "documents"), labels)
    out = model.score(odd)
    assert out.columns == [*odd.columns, "toxicity"]
    assert all(0 <= r["toxicity"] <= 1 for r in out.collect()) and out.count() == odd.count()
    assert model.score(no_docs).count() == 0
    few = Model().fit(spark.createDataFrame([(1, "a", 1), (2, "b", 0)], "doc_id long, text string, toxic int"))
    assert {r["toxicity"] for r in few.score(odd).collect()} == {0.5}
    assert without_toxic(odd, labels.where("false")).count() == odd.count()
