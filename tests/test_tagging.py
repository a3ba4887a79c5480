from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from foliolens.functions.tagged import sentences
from foliolens.functions.text import TAG_CLASSES
from foliolens.operators import tagging as tg
from tests.conftest import FOLDER

SCHEMA = "sentence long, words array<string>, tags array<string>"


@pytest.fixture(scope="module")
def tagger(spark):
    return tg.Tagger.fit(tg.corpus(spark))


def tags_of(tagger, rows, texts):
    return {r.i: r.tags for r in tagger.tag(rows("i int, text string", list(enumerate(texts)))).collect()}


def test_beats_the_majority_tagger_on_held_out_sentences(spark, rows):
    """Five folds: words of the corpus, with the lexicon known to both taggers."""
    data = sentences()
    right = majority = total = 0
    for fold in range(5):
        train = [s for s in data if s[0] % 5 != fold]
        test = [s for s in data if s[0] % 5 == fold]
        tagger = tg.Tagger.fit(spark.createDataFrame(train, SCHEMA))
        got = tags_of(tagger, rows, [" ".join(w) for _, w, _ in test])
        seen = defaultdict(Counter)
        for _, words, tags in train:
            for w, t in zip(words, tags):
                seen[w.lower()][t] += 1
        for t, ws in tg.LEXICON.items():
            for w in ws:
                seen[w][t] += 1
        for i, (_, words, tags) in enumerate(test):
            assert len(got[i]) == len(tags)
            right += sum(a == b for a, b in zip(got[i], tags))
            majority += sum((seen[w.lower()].most_common(1) or [("NN", 0)])[0][0] == t for w, t in zip(words, tags))
            total += len(tags)
    assert right / total > majority / total + 0.1  # 0.758 against 0.620 of 786 words


def test_context_decides(tagger, rows):
    got = tags_of(tagger, rows, ["They report the plan", "The report covers the plans", "She will plan a report", "They fish", "The fish"])
    assert got == {
        0: ["PRP", "VBP", "DT", "NN"], 1: ["DT", "NN", "VBZ", "DT", "NNS"], 2: ["PRP", "MD", "VB", "DT", "NN"], 3: ["PRP", "VBP"], 4: ["DT", "NN"],
    }


def plain_best(model, emissions):
    """Every sequence of tags, the best score; equal ones by the order in which decoding prefers them are not compared."""
    k, n = len(model["tags"]), len(emissions)
    best = None
    for path in itertools.product(range(k), repeat=n):
        score = model["first"][path[0]] + emissions[0][path[0]] + model["last"][path[-1]]
        score += sum(model["follow"][a, b] + emissions[i + 1][b] for i, (a, b) in enumerate(zip(path, path[1:])))
        if best is None or score > best[0] + 1e-12:
            best = score, path
    return best


def test_viterbi_against_all_paths():
    random = np.random.default_rng(3)
    k = 3
    for _ in range(20):
        model = {"tags": list("abc"), "first": random.normal(size=k), "follow": random.normal(size=(k, k)), "last": random.normal(size=k)}
        lengths = random.integers(1, 7, 5).tolist()
        emissions = random.normal(size=(8, k))
        words = random.integers(0, 8, sum(lengths))
        got = tg.viterbi(model, lengths, words, emissions)
        at = 0
        for n, path in zip(lengths, got):
            assert tuple(path) == plain_best(model, emissions[words[at : at + n]])[1]
            at += n


def test_long_sentences_are_decoded_the_same(monkeypatch):
    random = np.random.default_rng(4)
    k, lengths = 5, [40, 1, 300, 7]
    model = {"tags": list("abcde"), "first": random.normal(size=k), "follow": random.normal(size=(k, k)), "last": random.normal(size=k)}
    words, emissions = random.integers(0, 8, sum(lengths)), random.normal(size=(8, k))
    short = [t.tolist() for t in tg.viterbi(model, lengths, words, emissions)]
    monkeypatch.setattr(tg, "KEPT_WORDS", 10)
    assert [t.tolist() for t in tg.viterbi(model, lengths, words, emissions)] == short


def test_words_are_weighed_once(tagger, monkeypatch):
    """Unknown words are known by their endings alone, and what was worked out for one batch serves the next."""
    import pandas as pd

    made, plain = [], tg.emission
    monkeypatch.setattr(tg, "emission", lambda *a: made.append(a[2]) or plain(*a))
    texts = [" ".join(f"q{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}zzness" for i in range(100))] * 3
    run = tg._decoder(tagger.parts(), {}, "text", "tags", None)
    out = list(run(iter([pd.DataFrame({"text": texts[:1]}), pd.DataFrame({"text": texts})])))
    assert len(made) == 1 and [len(t) for b in out for t in b["tags"]] == [100] * 4


def test_equal_scores_take_the_first_tag():
    k = 4
    model = {"tags": list("abcd"), "first": np.zeros(k), "follow": np.zeros((k, k)), "last": np.zeros(k)}
    assert [t.tolist() for t in tg.viterbi(model, [3, 1], np.zeros(4, int), np.zeros((1, k)))] == [[0, 0, 0], [0]]


def test_counts_are_those_of_the_corpus(tagger):
    assert sum(n for a, _, n in tagger.pairs if a == tg.EDGE) == len(sentences())
    words = Counter((w.lower(), t) for _, ws, ts in sentences() for w, t in zip(ws, ts))
    listed = Counter((w, t) for t, ws in tg.LEXICON.items() for w in ws)
    assert {(r.word, r.tag): r.n for r in tagger.vocabulary.collect()} == dict(words + listed)
    model = tagger.parts()
    assert np.exp(model["follow"]).sum() < len(model["tags"]) + 1e-6
    assert model["prior"].sum() == pytest.approx(1)


def test_join_path_gives_the_same_tags(spark, tagger, monkeypatch):
    lines = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(60)
    lines = lines.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_idx", "text"))
    key = lambda frame: sorted((r.doc_id, r.line_idx, r.tags) for r in frame.collect())
    once = key(tagger.tag(lines))
    monkeypatch.setattr(tg, "fits_broadcast", lambda *_, **__: False)
    assert key(tagger.tag(lines)) == once


def test_save_and_load(spark, tagger, rows, tmp_path):
    tagger.save(str(tmp_path / "tagger"))
    again = tg.Tagger.load(spark, str(tmp_path / "tagger"))
    texts = ["The new plan works well", "x1 Paris fishes"]
    assert tags_of(again, rows, texts) == tags_of(tagger, rows, texts)


def test_odd_rows(tagger, rows, spark):
    texts = [None, "", "--- !!", "word " * 120_000, "ñandú 12 Überfluss", "a", "a"]
    got = tags_of(tagger, rows, texts)
    assert [len(got[i]) for i in range(len(texts))] == [0, 0, 0, 120_000, 3, 1, 1]
    assert got[4][1] == "CD" and got[5] == got[6]
    table = rows("tags string, text string, `odd name` int", [("clash", "The plan", 1)])
    out = tagger.tag(table)
    assert [f.simpleString() for f in out.schema] == ["text:string", "odd name:int", "tags:array<string>"]
    assert tagger.tag(table.limit(0)).collect() == []
    lone = tg.Tagger.fit(spark.createDataFrame([(0, ["x"], ["NN"]), (1, [], [])], SCHEMA), None)
    assert tags_of(lone, rows, ["x y"]) == {0: ["NN", "NN"]}


def test_query_counts_the_words_of_every_line(spark):
    got = entry.queries()["pos_tagged"](spark, FOLDER)
    assert got.columns == ["doc_id", "line_idx", *TAG_CLASSES]
    plain = entry.queries()["pos_counts"](spark, FOLDER)
    assert got.count() == plain.count()
    sums = got.agg(*[F.sum(c).alias(c) for c in TAG_CLASSES]).first()
    assert min(sums) >= 0 and sums.num_nouns > 0 and sums.num_conjunctions > 0
    # Digits are cardinals to both.
    both = got.join(plain.select("doc_id", "line_idx", F.col("num_cardinals").alias("listed")), ["doc_id", "line_idx"])
    assert both.where("listed > 0").count() == 0 or both.where("listed > 0 and num_cardinals > 0").count() > 0
