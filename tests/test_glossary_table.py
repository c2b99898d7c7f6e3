"""Glossary as a table: repeated ids, repeated words, and no row per word in the join."""

from webtext.operators import glossary as G


def test_repeated_ids_and_words(spark):
    docs = spark.createDataFrame(
        [(1, "a b c"), (1, "b a"), (None, "c"), (None, "c d"), (2, "a  b"), (3, " "), (4, None)], "document_id long, text string"
    )
    table = spark.createDataFrame([("a", "x y"), ("b", "q"), ("b", "p"), ("c", None), (None, "n")], "word string, translation string")
    found = {r.document_id: (r.text, r.pieces) for r in G.translate_with_table(docs, table, 2).collect()}
    assert found == {1: ("p q x y p q x y\nc", 2), None: ("c c d", 1), 2: ("x y p q", 1)}


def test_join_sees_a_word_once_a_pack(spark, monkeypatch):
    """Before, the join took one row for each of the 20,000 words."""
    docs = spark.range(200).selectExpr("id as document_id", "trim(repeat('w v ', 50)) as text").coalesce(1)
    table = spark.createDataFrame([("w", "W")], "word string, translation string")
    rows = spark.range(0).sparkSession.createDataFrame([(0, "w v w"), (0, "v"), (1, "w")], "pack long, chunk string").coalesce(1)
    assert sorted(map(tuple, rows.mapInArrow(G.pack_words, "pack long, word string").collect())) == [(0, "v"), (0, "w"), (1, "w")]
    done = G.translate_with_table(docs, table, 7)
    assert {r.text.replace("\n", " ") for r in done.collect()} == {" ".join(["W v"] * 50)}
    assert {r.pieces for r in done.collect()} == {15}
