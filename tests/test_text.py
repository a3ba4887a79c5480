from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from foliolens.functions import text as tx
from foliolens.functions import vectors as vec


def one(spark, column, text):
    from pyspark.sql import functions as F

    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, stripped, collapsed, words",
    [
        ("", "", "", 0), (" ", "", "", 0), ("a", "a", "a", 1), (" a  b ", "a  b", "a b", 2), ("one two", "one two", "one two", 2),
        ("x  y", "x  y", "x y", 2), ("tab\tand\nline", "tab\tand\nline", "tab\tand\nline", 3), ("\u3000wide\u3000", "wide", "wide", 1),
        ("a \t\n b", "a \t\n b", "a b", 2),
    ],
)
def test_words_and_strip(spark, text, stripped, collapsed, words):
    assert one(spark, tx.strip, text) == stripped
    assert one(spark, tx.collapse, text) == collapsed
    assert one(spark, tx.word_count, text) == words
    assert one(spark, lambda t: tx.words_of_collapsed(tx.collapse(t)), text) == words


def by_characters(text):
    """Collapsed text, words, and flags of a text, character by character."""
    out, word, words, gap = "", False, 0, ""
    for c in text:
        if c.isspace():
            gap += c
            word = False
            continue
        if out:
            out += " " if len(gap) > 1 else gap
        gap = ""
        words += not word
        word = True
        out += c
    cased = [c for c in text if c.lower() != c.upper()]
    upper = int(bool(cased) and all(c == c.upper() for c in cased))
    letters = 0
    for c in text:
        letters += c.isalpha() or c.isdigit()
    return out, words, upper, int(text[:1] in set("0123456789") and text != ""), int(text[-1:] == ":"), letters >= 3


def test_many_texts_against_a_loop_over_characters(spark):
    from pyspark.sql import functions as F

    seen = []

    @settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.text(alphabet="aB9. :\t\n  é", max_size=24))
    def gather(text):
        seen.append((text,))

    gather()
    t = F.col("t")
    result = spark.createDataFrame(seen, "t string").select(
        "t", tx.collapse(t), tx.word_count(t), tx.is_upper(t), tx.is_numbered(t), tx.ends_with_colon(t), tx.has_alnum(t, 3)
    )
    for text, *got in result.collect():
        assert tuple(got) == by_characters(text)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("short", "short"),
        ("x" * 100, "x" * 100),
        ("x" * 101, "x" * 100 + "..."),
        ("." + "x" * 120, "." + "x" * 99 + "..."),
        ("x" * 99 + "." + "y" * 20, "x" * 99 + "."),
        ("x" * 100 + "." + "y" * 20, "x" * 100 + "..."),
        ("One.  Two " + "z" * 120, "One."),
        ("a" * 99 + "  " + "b" * 30, "a" * 99 + "..."),
    ],
)
def test_title_limits(spark, text, expected):
    assert one(spark, tx.clean_title, text) == expected


def test_bold(spark):
    assert one(spark, lambda t: tx.bold_from_font(t), "Arial-BLACK") == 1
    assert one(spark, lambda t: tx.bold_from_font(t), "Arial") == 0
    assert spark.range(4).select(tx.bold_from_flags("id")).collect() == [(0,), (0,), (1,), (1,)]


def test_word_classes(spark):
    counts = spark.createDataFrame([("He quickly walked to 3 large houses and sang, wow",)], "t string").select(
        tx.word_tags("t").alias("tags")
    ).select(*tx.tag_counts("tags")).first()
    assert counts.asDict() == {
        "num_verbs": 1, "num_nouns": 2, "num_adjectives": 1, "num_adverbs": 1, "num_pronouns": 1, "num_cardinals": 1,
        "num_conjunctions": 1, "num_predeterminers": 0, "num_interjections": 1,
    }


def test_marks_count_what_tags_count(spark):
    listed = [w for words in tx.LEXICON.values() for w in words]
    endings = [f"xq{e}" for e, _ in tx.SUFFIXES] + [e for e, _ in tx.SUFFIXES]
    odd = ["", None, "--", "007 1a a1 12", "½ ² ٣ 3٣", "It's ALL Yes; no: yet", "İs é ñing Übung", "a" * 3000, "one two 3 four " * 500]
    frame = spark.createDataFrame([(t,) for t in [*listed, *endings, " ".join(listed), " ".join(endings), *odd]], "t string")
    tags = frame.select("t", tx.word_tags("t").alias("x")).select("t", *tx.tag_counts("x"))
    marks = frame.select("t", tx.word_marks("t").alias("x")).select("t", *tx.mark_counts("x"))
    assert marks.schema == tags.schema and marks.exceptAll(tags).isEmpty() and tags.exceptAll(marks).isEmpty()
    custom = {"UH": ["so", "12"], "RB": ["so", "the"]}
    tags = frame.select(tx.word_tags("t", custom).alias("x")).select(*tx.tag_counts("x"))
    marks = frame.select(tx.word_marks("t", custom).alias("x")).select(*tx.mark_counts("x"))
    assert marks.exceptAll(tags).isEmpty()


def test_vectors(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    row = frame.select(
        vec.cosine(F.col("a"), F.col("b")), vec.cosine(F.col("a"), F.col("z")), vec.normalised(F.col("a"))
    ).first()
    assert row[0] == pytest.approx(0.96)
    assert row[1] == 0.0
    assert row[2] == pytest.approx([0.6, 0.8])
