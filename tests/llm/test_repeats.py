"""Removal of repeated units against a plain pass over the sorted documents."""

from webtext.llm.queries import QUERIES
from webtext.llm.repeats import EDGES, MIN_WORDS, normal_words, repeated, units, without_repeats

PASSAGE = "Here stands a sentence of quite some words indeed. Short one. Another long sentence follows it with many more words, to be sure! And yet another that goes on for a good while too."


def brute(rows):
    """Cuts ``(doc_id, start, end, words, kept)`` of rows with distinct ids."""
    first, out = {}, []
    for doc_id, text in sorted(rows):
        for start, end, words, key in units(text):
            if not words or len(key) < MIN_WORDS:
                continue
            key = tuple(key)
            if key in first:
                out.append((doc_id, start, end, len(words), first[key]))
            else:
                first[key] = doc_id
    return sorted(out)


def test_query_equals_brute_force(spark, sf, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, QUERIES["op3_repeats"](spark, sf).collect())) == brute(rows)


def test_units_cover_the_text(docs):
    for r in docs.collect():
        cut = units(r.text)
        assert "".join(r.text[s:e] for s, e, *_ in cut) == r.text
        assert [w for _, _, ws, _ in cut for w in ws] == normal_words(r.text)


def test_passage_inside_other_lines(spark):
    rows = [(1, f"Some words before it come first here. {PASSAGE} After it come others."), (2, f"Nothing like it.\n{PASSAGE}\nThe end is near."), (3, "A clean text of its own words, with nothing that anyone else has written so far.")]
    out = {r["doc_id"]: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["text"] == rows[0][1] and out[1]["removed"] is None
    assert out[3]["text"] == rows[2][1] and out[3]["removed"] is None
    assert out[2]["text"] == "Nothing like it.\nThe end is near."
    assert {c["kept_doc_id"] for c in out[2]["removed"]} == {1}
    assert "".join(rows[1][1][c["start"] : c["end"]] for c in out[2]["removed"]) == PASSAGE + "\n"


def test_common_units_are_joined_apart(spark):
    rows = [(i, f"{PASSAGE} own{i} words of text {i} that no one else has{i} for all that{i} is.") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, repeated(df).drop("th").collect()))
    assert len(want) == 1199 * 4 and want == brute(rows)


def test_words_at_edges():
    for text in ("--a_b-- _x_ 'don't' (ü)… «é», ... 5% \u00b2 a\u0301. \u2014", "_", "^`{|}~\\", "x"):
        assert normal_words(text) == [w for w in (EDGES.sub("", x) for x in text.lower().split()) if w]


def test_odd_rows(odd, no_docs):
    out = without_repeats(odd)
    assert out.columns == [*odd.columns, "removed"]
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert len(by[2]) == 2 and by[2] == ["", ""] and by[1] != [""]
    assert by[3] == [""] and by[4] == [None] and len(by[None]) == 1
    assert repeated(no_docs).count() == 0 and without_repeats(no_docs).count() == 0
