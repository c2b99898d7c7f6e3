"""Words, chunks, summaries, glossary and models against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webtext.functions import text as T
from webtext.operators import chunks, inference
from webtext.operators.glossary import translate_with_table
from webtext.operators.summary import summarize


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "document_id bigint, text string")


def collected(df, column):
    return [r[column] for r in df.orderBy("document_id").collect()]


SPACED = ["", " \n\t\xa0", "a", " a  b\n", "x\x1cy\x85z　w​v", "é\x0bü"]


def test_words_split_like_unicode_text(spark):
    df = docs_of(spark, SPACED).select("document_id", T.words(F.col("text")).alias("w"))
    assert collected(df, "w") == [t.split() for t in SPACED]


def test_blank_is_null(spark):
    df = docs_of(spark, SPACED).select("document_id", T.blank_to_null(F.col("text")).alias("t"))
    assert collected(df, "t") == [t if t.strip() else None for t in SPACED]


@pytest.mark.parametrize("n, pieces", [(0, 0), (1, 1), (500, 1), (501, 2), (1000, 2), (25_001, 51)])
def test_chunk_sizes(spark, n, pieces):
    text = " \n".join(f"w{i}" for i in range(n))
    got = chunks.chunk_words(docs_of(spark, [text])).orderBy("chunk_idx").collect()
    assert len(got) == pieces
    assert [len(r.chunk.split(" ")) for r in got] == [500] * (pieces - 1) + ([n - 500 * (pieces - 1)] if n else [])
    assert " ".join(r.chunk for r in got) == " ".join(text.split())


def test_minimum_is_inclusive(spark):
    df = docs_of(spark, ["w " * 99, "w " * 100]).where(T.has_min_words(F.col("text")))
    assert collected(df, "document_id") == [1]


def test_segment_names_grow_past_four_digits(spark):
    df = spark.createDataFrame([(0,), (9999,), (12345,)], "i int").select(T.segment_name(F.col("i")).alias("n"))
    assert [r.n for r in df.collect()] == ["0000.wav", "9999.wav", "12345.wav"]


def test_rejoin_parts_are_the_whole_text(spark):
    rows = [("a", i, f"x{i}") for i in range(25)] + [("b", 0, "y")]
    random.Random(1).shuffle(rows)
    pieces = spark.createDataFrame(rows, "k string, i int, v string")
    got = chunks.rejoin(pieces, "k", "i", "v", "text", part_size=10).orderBy("k", "part").collect()
    assert [(r.k, r.part, r.pieces) for r in got] == [("a", 0, 10), ("a", 1, 10), ("a", 2, 5), ("b", 0, 1)]
    assert "\n".join(r.text for r in got if r.k == "a") == "\n".join(f"x{i}" for i in range(25))


def test_long_text_is_rejoined_in_one_row(spark):
    pieces = spark.range(12_001).select(F.lit("a").alias("k"), "id", F.col("id").cast("string").alias("v"))
    got = chunks.rejoin(pieces, "k", "id", "v", "text").collect()
    assert [(r.k, r.pieces) for r in got] == [("a", 12_001)]
    assert got[0].text.split("\n") == [str(i) for i in range(12_001)]


def test_playlist_is_made_in_the_row(spark):
    docs = spark.createDataFrame([(1, "A. B! c"), (2, ""), (3, None), (4, "x. " * 12_000)], "document_id int, text string")
    got = {r.document_id: (r.playlist, r.pieces) for r in chunks.speech_playlist(docs).collect()}
    assert got[1] == ("0000.wav\n0001.wav\n0002.wav", 3)
    assert set(got) == {1, 4} and got[4][0].endswith(f"\n{got[4][1] - 1}.wav") and got[4][1] >= 12_000


def test_stage_takes_a_glossary_of_any_size(spark):
    from webtext.plans import stages

    docs = docs_of(spark, ["the cat of x", "   "])
    large = GLOSSARY | {str(i): "y" for i in range(T.MAX_GLOSSARY)}
    table = spark.createDataFrame(list(GLOSSARY.items()), "word string, translation string")
    want = sorted(map(str, stages.translations(docs, GLOSSARY).collect()))
    assert sorted(map(str, stages.translations(docs, large).collect())) == want
    assert sorted(map(str, stages.translations(docs, table).collect())) == want


GLOSSARY = {"the": "le", "of": "du tout", "x": ""}


def translated(text):
    w = [GLOSSARY.get(x, x) for x in text.split()]
    # Chunks are cut before translation.
    return "\n".join(" ".join(w[i : i + 500]) for i in range(0, len(w), 500)) or None


def test_translation_by_literal_and_by_table(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "of", "cat", "x"]) for _ in range(n)) for n in (1, 499, 500, 1203)]
    docs = docs_of(spark, texts + ["   "])
    by_literal = docs.select("document_id", T.translate(F.col("text"), GLOSSARY).alias("t"))
    want = [translated(t) for t in texts] + [None]
    assert collected(by_literal, "t") == want
    table = spark.createDataFrame(list(GLOSSARY.items()), "word string, translation string")
    assert collected(translate_with_table(docs, table), "text") == want[:-1]


def test_glossary_size_is_checked():
    for wrong in ({}, {str(i): "x" for i in range(T.MAX_GLOSSARY + 1)}):
        with pytest.raises(ValueError):
            T.translate(None, wrong)


def summary_of(text, max_words=800, min_words=150):
    sentences, current = [], ""
    for c in text:
        ended = current and current[-1] in ".!?"
        if c == "\n" or (ended and c not in ".!?"):
            sentences.append(current)
            current = ""
        if c != "\n" and not (c in ".!?" and not current):
            current += c
    sentences = [s for s in sentences + [current] if s.split()]
    freq = Counter(w for s in sentences for w in s.split())
    score = [sum(freq[w] for w in s.split()) / len(s.split()) for s in sentences]
    kept, before = [], 0
    for i in sorted(range(len(sentences)), key=lambda i: (-score[i], i)):
        n = len(sentences[i].split())
        if before < min_words and before + n <= max_words:
            kept.append(i)
        before += n
    return " ".join(sentences[i].strip(" ") for i in sorted(kept)) if kept else None


def test_summary_equals_plain_python(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["the"] * 20
    texts = ["", "one", "no end", "a. a. b!? c\n\nd e", "long " * 801 + "."]
    for _ in range(60):
        n = rng.randrange(1, 700)
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", ". ", "! ", "\n"]) for _ in range(n)))
    got = collected(summarize(docs_of(spark, texts)), "summary")
    assert got == [summary_of(t) for t in texts]


def test_model_is_made_once_per_partition_and_errors_stay_with_their_row(spark, tmp_path):
    log = str(tmp_path / "made")

    def make_model():
        with open(log, "a") as f:
            f.write("x")

        def model(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("bad text")
            return [t.upper() for t in texts]

        return model

    docs = docs_of(spark, ["a", "bad", " ", None, "c"] + ["d"] * 95).coalesce(1)
    rows = {int(r.document_id): r for r in inference.batch_inference(docs, make_model, 10).collect()}
    assert len(rows) == 100 and open(log).read() == "x"
    assert (rows[0].output, rows[4].output, rows[99].output) == ("A", "C", "D")
    assert (rows[1].output, rows[1].error, rows[1].success) == (None, "bad text", False)
    assert rows[2].error == rows[3].error == "empty text"


def test_model_with_missing_outputs_is_run_item_by_item(spark):
    docs = docs_of(spark, ["a", "b", "c"]).coalesce(1)
    out = inference.batch_inference(docs, lambda: lambda texts: texts[:1])
    assert collected(out, "output") == ["a", "b", "c"]


def test_translation_by_model_fails_whole_documents(spark):
    texts = ["a b c d e", "a bad c worse", " ", "x"]

    def make_model():
        def model(chunks):
            for c in chunks:
                if "bad" in c or "worse" in c:
                    raise ValueError(c)
            return [c.upper() for c in chunks]

        return model

    got, rows = inference.translate_with_model(docs_of(spark, texts), make_model, size=2)
    assert {r.document_id: r.text for r in got.collect()} == {0: "A B\nC D\nE", 3: "X"}
    assert collected(rows, "error") == [None, "a bad", "empty text", None]
