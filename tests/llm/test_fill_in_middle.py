"""Cuts, forms and rebuilt texts against a plain loop over the units of each text."""

import hashlib
import re

import numpy as np
import pytest

from webtext.llm import fill_in_middle as fim
from webtext.llm.queries import QUERIES, SQL


def brute(key, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * g : 8 * g + 8], 16) for g in range(4))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    "", "a", "abc", " ", "<P>", "x<S>y", "<", "<P", "a<M", "P>", "<<<>>>", "naïve \U0001f600 café\r\n", "é" * 2000,
    "word " * 5000, "z" * 100_000, "ab1" * 3333 + "<", "\0\x1c tab\t", "<<P>", "S>M>P>" * 50, None,
]


@pytest.fixture
def awkward(spark):
    rows = [(None if i == 7 else i, t, "clash", 1) for i in range(12) for t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, n int")


def test_equals_loop_and_round_trip(spark, awkward, docs, odd):
    for df in (awkward, docs, odd):
        given = fim.fill_in_middle(df)
        got = given.select("*", fim.restored("output", "form").alias("back")).collect()
        assert len(got) == df.count()
        for r in got:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
            assert r.back == r.text
    assert {r.form for r in fim.fill_in_middle(awkward).collect()} == {"plain", "spm", "psm"}


def test_empty_table_and_query(spark, sf, awkward, docs):
    assert fim.fill_in_middle(awkward.where("false")).count() == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        *_, output = brute(r.doc_id, texts[r.doc_id])
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_query_equals_sql(spark, sf, duck):
    got = QUERIES["op13_fill_in_middle"](spark, sf)
    want = duck.sql(SQL["op13_fill_in_middle"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_tree_descent():
    counts = np.random.default_rng(5).integers(0, 4, 37)
    tree = fim.Fenwick(counts)
    owner = np.repeat(np.arange(37), counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    for rank, block in enumerate(owner):
        assert tree.descend(rank) == (block, rank - first[block])
    assert [tree.before(b) for b in range(38)] == first.tolist()
