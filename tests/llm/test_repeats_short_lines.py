"""Passages of short lines and of scripts without spaces."""

import random

from webtext.llm.repeats import normal_words, units, without_repeats

rng = random.Random(8)
VERSE = [" ".join(f"{chr(97 + i)}{rng.randrange(10**6)}" for _ in range(6)) for i in range(10)]


def own(n):
    return " ".join(f"own{n}x{i}" for i in range(12)) + "."


def texts(spark, *texts):
    out = without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r["text"] for r in sorted(out, key=lambda r: r["doc_id"])]


def test_paragraph_of_short_lines(spark):
    verse = "\n".join(VERSE)
    given = [f"{own(n)}\n\n{verse}\n\n{own(n + 9)}" for n in (1, 2)] + [verse]
    assert texts(spark, *given) == [given[0], f"{own(2)}\n\n{own(11)}", ""]


def test_a_text_without_repeats_stays(spark):
    """The last two lines are keyed by the same words, but none is a repeat of the other."""
    verse = "\n".join(VERSE)
    assert texts(spark, verse) == [verse]


def test_short_lines_inside_a_paragraph(spark):
    """All but the last line, whose neighbours differ, go."""
    verse = "\n".join(VERSE)
    given = [f"{own(n)}\n{verse}\n{own(n + 9)}" for n in (1, 2)]
    assert texts(spark, *given) == [given[0], f"{own(2)}\n{VERSE[-1]}\n{own(11)}"]


def test_list_of_paragraphs_and_whole_lines(spark):
    items = "\n\n".join(VERSE)
    assert texts(spark, f"{own(1)}\n\n{items}", f"{own(2)}\n\n{items}")[1] == f"{own(2)}\n\n"
    line = f"Not so. {own(5)} And yet. It is."
    assert texts(spark, f"{own(1)}\n{line}\n{own(2)}", f"{own(3)}\n{line}\n{own(4)}")[1] == f"{own(3)}\n{own(4)}"


def test_scripts_without_spaces(spark):
    passage = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少。"
    thai = "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอนหรือวรรณยุกต์"
    out = texts(spark, f"你好。{passage}", f"再见吧。{passage}\n{thai}", f"{own(1)}\n{thai}")
    assert out == [f"你好。{passage}", f"再见吧。{thai}", f"{own(1)}\n"]


def test_units_cover_odd_texts():
    for t in ("", "\n\n x", "a. b! c?\n\n\n---\n***\nd", "你好。世界！\n\nno 三 yes", "\n".join(VERSE), "-\n" * 1000 + "x y"):
        cut = units(t)
        assert "".join(t[s:e] for s, e, *_ in cut) == t
        assert [w for _, _, ws, _ in cut for w in ws] == normal_words(t)
