"""Extractive summaries of chosen sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.functions.text import sentences, tokens
from foliolens.operators.relevance import SCORE_DIGITS


def refined_text(text: Column, terms: Column, keep: int = 3, max_chars: int | None = None) -> Column:
    """The `keep` sentences of highest mean term weight, in their own order; `max_chars` cuts the result, where that is wanted.

    `terms` maps the section's terms to their weights.  Equal means, at nine decimals, go by position.
    """

    def mean_weight(words: Column) -> Column:
        total = F.aggregate(words, F.lit(0.0), lambda sum_, t: sum_ + F.coalesce(F.element_at(terms, t), F.lit(0.0)))
        return F.when(F.size(words) > 0, total / F.size(words)).otherwise(F.lit(0.0))

    split = F.transform(sentences(text), lambda s, i: F.struct(i.alias("at"), s.alias("sentence"), tokens(s).alias("words")))
    weighed = F.transform(
        split,
        lambda s: F.struct(
            (-F.round(mean_weight(s["words"]), SCORE_DIGITS)).alias("below"), s["at"].alias("at"), s["sentence"].alias("sentence")
        ),
    )
    return _best(weighed, keep, max_chars)


def _best(weighed: Column, keep: int, max_chars: int | None) -> Column:
    best = F.transform(F.slice(F.array_sort(weighed), 1, keep), lambda s: F.struct(s["at"].alias("at"), s["sentence"].alias("sentence")))
    joined = F.array_join(F.transform(F.array_sort(best), lambda s: s["sentence"]), " ")
    return F.substring(joined, 1, max_chars) if max_chars else joined


def refined_sentences(text: Column, means: Column, keep: int = 3, max_chars: int | None = None) -> Column:
    """The same from the mean weights of the sentences, in their order."""
    # Zipped, since what a lambda takes from outside is made anew for every element.
    pairs = F.zip_with(sentences(text), means, lambda s, m: F.struct(s.alias("sentence"), m.alias("mean")))
    weighed = F.transform(
        pairs,
        lambda s, i: F.struct((-F.round(s["mean"], SCORE_DIGITS)).alias("below"), i.alias("at"), s["sentence"].alias("sentence")),
    )
    return _best(weighed, keep, max_chars)


def refine(chosen: DataFrame, keep: int = 3, max_chars: int | None = None) -> DataFrame:
    """Adds refined_text to sections that carry their text and its `terms`, or `sentences` and the hash of their text (`text_hash`).

    Each row is summarised by itself, from its whole text.  Of `sentences` it takes those of its own text, as texts at one place share them.
    """
    text = F.col("text")
    if "sentences" not in chosen.columns:
        return chosen.withColumn("refined_text", refined_text(text, F.col("terms"), keep, max_chars))
    own = F.filter("sentences", lambda s: s["text"] == F.col("text_hash"))
    return chosen.withColumn("refined_text", refined_sentences(text, F.transform(own, lambda s: s["mean"]), keep, max_chars))
