from __future__ import annotations

import random

from pyspark.sql import functions as F

from foliolens.llm import lines
from foliolens.llm.lines import drop_lines, line_dedup


def brute(docs):
    lines = sorted((d, i, frozenset(line.split())) for d, t in docs for i, line in enumerate((t or "").split("\n")))
    out = {d: [0, []] for d, _ in docs}
    for k, (d, i, s) in enumerate(lines):
        out[d][0] += 1
        if s and any(100 * len(s & u) >= 80 * len(s | u) for _, _, u in lines[:k]):
            out[d][1].append(i)
    return sorted((d, n, len(gone), gone) for d, (n, gone) in out.items())


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 20 + ["Ä", "the,"]
    base = [draw.choices(vocabulary, k=draw.choice([1, 2, 4, 5, 6, 10, 20, 45])) for _ in range(40)]
    docs = []
    for d in range(n):
        lines = []
        for _ in range(draw.randint(0, 6)):
            line = list(draw.choice(base))
            for _ in range(draw.choice([0, 1, 1, 3])):
                line[draw.randrange(len(line))] = draw.choice(vocabulary)
            lines.append(draw.choice([" ", "\t", "  "]).join(line) + draw.choice(["", " ", "\r"]))
        docs.append((d * 7 % 1001, "\n".join(lines)))
    return docs


def test_against_brute_force(rows):
    docs = corpus(1, 120) + [(5000, None), (5001, ""), (5002, "\n \n\t"), (5003, "x\nx\n x x"), (5004, "q " * 50_000 + "\nq")]
    frame = rows("doc_id long, text string, line int, tokens string", [(*d, 0, "") for d in docs])
    got = sorted((r.doc_id, r.n_lines, r.n_removed, r.removed) for r in line_dedup(frame).collect())
    assert got == brute(docs)
    assert any(n for _, _, n, _ in got)


def test_texts_without_the_removed_lines(rows):
    docs = rows("doc_id long, text string, _x int", [(1, "a b c\nd", 0), (2, "a b c\n\ne\nd", 1), (3, None, 2), (None, "z", 3)])
    out = drop_lines(docs)
    assert out.columns == docs.columns
    assert sorted((r._x, r.text) for r in out.collect()) == [(0, "a b c\nd"), (1, "\ne"), (2, None), (3, "z")]


def test_empty_table_and_repeated_rows(rows):
    assert line_dedup(rows("doc_id long, text string", [])).collect() == []
    got = line_dedup(rows("doc_id long, text string", [(1, "a\nb"), (1, "a\nb"), (2, "b")])).collect()
    assert sorted((r.doc_id, r.n_lines, r.removed) for r in got) == [(1, 4, []), (2, 1, [0])]


def test_no_python_in_the_plan(spark, rows):
    plan = line_dedup(rows("doc_id long, text string", [(1, "a b c")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_large_sets_are_told_apart_before_they_are_read_again(rows, monkeypatch):
    draw = random.Random(3)
    docs = [(d, " ".join(draw.sample([f"w{i}" for i in range(400)], 150))) for d in range(200)]
    docs.append((900, docs[7][1].replace(" ", "\x0b\t", 3).rsplit(" ", 9)[0]))
    staged, stage = {}, lines.stage

    def count(table, name):
        staged[name] = stage(table, name)
        return staged[name]

    monkeypatch.setattr(lines, "stage", count)
    got = {r.doc_id: r.n_removed for r in line_dedup(rows("doc_id long, text string", docs)).collect()}
    assert [d for d, n in got.items() if n] == [900]
    assert sum(t.count() for name, t in staged.items() if name in ("line-stars", "line-pairs")) < 100


def test_frequent_tokens_settle_near_copies_and_their_neighbours(rows, monkeypatch):
    monkeypatch.setattr(lines, "HOT", 3)
    docs = corpus(5, 120) + [(5000 + i, "a b c d e f g h i j k l m n o " + f"x{i}") for i in range(40)] + [(6000, "a b c d e f g h i j k l m y x3")]
    got = sorted((r.doc_id, r.n_lines, r.n_removed, r.removed) for r in line_dedup(rows("doc_id long, text string", docs)).collect())
    assert got == brute(docs)


def test_filter_of_lines_loses_none(rows):
    found = rows("doc_id long, line_no int", [(d, d % 5) for d in range(0, 3000, 3)])
    every = rows("doc_id long, line_no int", [(d, d % 5) for d in range(3000)])
    kept = {r.doc_id for r in every.filter(lines._among(found, "doc_id", "line_no")).collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 1100
    assert every.filter(lines._among(found.filter(F.lit(False)), "doc_id")).count() == 0
