from __future__ import annotations

import numpy as np
import pytest

from foliolens.llm import language
from foliolens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("classes", [1, 2, 4, 6, 9, 20])
def test_codewords_are_far_apart(classes):
    code = language.codewords(classes)
    assert len(code) == classes
    for i in range(classes):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= (1 if classes < 3 else code.shape[1] / 4)


def test_decoding_corrects_a_wrong_bit_and_flags_ties():
    code = language.codewords(4)
    trust = np.ones_like(code) / code.shape[1]
    margins = 3 * code.copy()
    margins[:, 0] *= -0.5
    best, score, unsure = language.decode(margins, code, trust)
    assert list(best) == [0, 1, 2, 3] and not unsure.any() and (score > 0.5).all()
    assert language.decode(np.zeros((1, code.shape[1])), code, trust)[2][0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [d for d, r in got.items() if r.held_out]
    assert set(got) == set(truth) and len(held) > 150
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark, rows):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    texts = [None, "", "1234 -- 99", "The of and to in is that the and", "the " * 200_000, "x"]
    docs = rows("doc_id long, text string, lang int, score string", [(i % 5, t, None, "s") for i, t in enumerate(texts)])
    got = language.identify(docs, model, ("a", "b", "c")).collect()
    assert [r.a == "und" for r in got] == [True, True, True, False, False, False]
    assert [r.b for r in got[:3]] == [0.0] * 3 and all(r.c for r in got[:3])
    assert got[3].a == "en" and [r.score for r in got] == ["s"] * 6
    assert language.identify(docs.limit(0), model, ("a", "b", "c")).collect() == []


def test_nothing_to_learn_from(rows):
    docs = rows("doc_id long, text string, lang string", [(1, "abc", None), (None, "abc", "en")])
    got = language.identify(docs, language.fit(docs)).collect()
    assert [r.lang_pred for r in got] == ["und", "und"]
    kept = language.known_language(docs, docs)
    assert kept.collect() == [] and kept.columns == docs.columns


def test_one_language(rows):
    docs = rows("doc_id long, text string, lang string", [(i, "some text", "en") for i in range(30)])
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()} == {"en"}


def test_a_language_of_nine_tenths_repeated_rows_and_many_languages(rows, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "train", lambda x, classes, code: seen.append(np.bincount(classes)) or (None, None))
    schema = "doc_id long, text string, lang string, _hash int, n int"
    made = [(i, f"text {i}", "en" if i % 10 else "de", 0, 0) for i in range(4000)] + [(7, "again", "en", 0, 0)] * 500 + [(None, "t", "en", 0, 0)]
    assert language.fit(rows(schema, made), 100)[0] == ["de", "en"]
    assert list(seen.pop()) == [50, 50]
    many = [(i, "text", f"l{i % 300:03d}", 0, 0) for i in range(3000)] + [(9000 + i, "text", "l299", 0, 0) for i in range(50)]
    languages = language.fit(rows(schema, many), 100)[0]
    assert len(languages) == 100 and "l299" in languages and len(seen.pop()) == 100
    assert language.fit(rows(schema, []), 100) == ([], None)
