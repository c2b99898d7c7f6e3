"""Fingerprints against a plain computation of the edited texts and true similarity."""

import hashlib

from webtext.llm.fingerprints import signature, likeness, with_next
from webtext.llm.queries import QUERIES


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def true_likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query(spark, sf, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    got = QUERIES["op6_fingerprints"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(ids)
    prints, errors = {}, []
    for r in got:
        text, following = texts[r.doc_id], texts[after[r.doc_id]]
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        assert r.n_chars == n
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        errors += [abs(r.near_edited - true_likeness(text, edited)), abs(r.near_next - true_likeness(text, following))]
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.3


def test_odd_rows(odd, no_docs):
    got = with_next(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[3]["fingerprint"] == "" and by[4]["n_chars"] == 0
    assert by[1]["fingerprint"] == by[2]["fingerprint"] != ""
    assert by[4]["near_next"] == 1.0  # the next of 4 is 3: both empty
    assert with_next(no_docs).count() == 0
    alone = with_next(odd.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_likeness_is_unbiased(spark):
    """Over many pairs of word lists with half their shingles in common."""
    rows = [(" ".join(f"a{k}x{i}" for i in range(90)), " ".join(f"a{k}x{i}" if i < 60 else f"b{k}x{i}" for i in range(90))) for k in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(likeness(signature("a"), signature("b"))).collect()]
    true = 56 / (86 + 86 - 56)
    assert abs(sum(got) / len(got) - true) < 0.03
