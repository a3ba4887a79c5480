from __future__ import annotations

import itertools
import re
from collections import defaultdict

from pyspark.sql import functions as F

from foliolens.llm import audit
from foliolens.llm.audit import audit_filters, failing_combinations, interactions, later_copies

DOCS = "doc_id long, text string, source string, key int, bits string, part string"
LABELS = "doc_id long, quality int, toxic int, text string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    parts = defaultdict(list)
    for doc_id, text, source in docs:
        text = text or ""
        copy = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs)
        parts[source or ""].append((doc_id, [*fails(text), copy]))
    out = {}
    for part, rows in parts.items():
        removed_by = defaultdict(int)
        for order in itertools.permutations(range(5)):
            left = rows
            for step, f in enumerate(order):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                removed_by[f] += len(gone)
                out[part, "".join("ABCDE"[k] for k in order), step + 1] = [
                    len(left), len(gone), sum(r[1][f] and any(r[1][g] for g in order[:step]) for r in rows),
                    sum(r[1][f] and sum(r[1]) == 1 for r in rows), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), f,
                ]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = removed_by[out[key][-1]]
    return {(*k, *v) for k, v in out.items()}


def odd_documents():
    plain = " ".join(f"w{i}" for i in range(60))
    texts = [
        plain, plain, plain.upper(), "same " * 60, plain + " #", "A B", None, "", "w " * 30_000, "é " * 60, plain + " x", "a\x0bb c\x1cd", "|",
    ]
    docs = [(i + 100 * k, t, [None, "", "s", "t"][(i + k) % 4]) for k in range(3) for i, t in enumerate(texts)]
    docs += [(None, plain, "s"), (None, plain, "s"), (5, "twice", "s"), (5, "twice", "s"), (5, "other", "t"), (6, "twice", None), (7, "lone", "only")]
    labels = [(d, q, t) for d, q, t in [(0, 1, 0), (1, 1, 1), (1, 0, 0), (2, None, 1), (100, 0, 1), (5, 1, 1), (None, 1, 1), (999, 1, 1), (7, 1, None)]]
    return docs, labels


def tables(rows, docs, labels):
    return rows(DOCS, [(*d, 0, "x", "y") for d in docs]), rows(LABELS, [(*x, "clash") for x in labels])


def test_against_brute_force_on_odd_rows(rows):
    docs, labels = odd_documents()
    out = audit_filters(*tables(rows, docs, labels))
    assert out.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) == 600 * len({d[2] or "" for d in docs})
    assert set(got) == brute(docs, labels)


def test_texts_that_share_a_key_are_told_apart(rows):
    docs, labels = odd_documents()
    a, b = tables(rows, docs, labels)
    want = {tuple(r) for r in failing_combinations(a, b).collect()}
    assert {tuple(r) for r in failing_combinations(a, b, key=F.lit(1).cast("long")).collect()} == want
    assert {tuple(r) for r in failing_combinations(a, b, key=F.char_length("text").cast("long")).collect()} == want


def test_without_broadcast(rows, monkeypatch):
    docs, labels = odd_documents()
    a, b = tables(rows, docs, labels)
    want = {tuple(r) for r in failing_combinations(a, b).collect()}
    monkeypatch.setattr(audit, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr("foliolens.plans.lineage.fits_broadcast", lambda *_: False)
    assert {tuple(r) for r in failing_combinations(a, b).collect()} == want
    assert {tuple(r) for r in failing_combinations(a, b, key=F.lit(1).cast("long")).collect()} == want


def test_large_sides_do_not_pass_the_driver(rows, monkeypatch):
    """What a count shows to be large is shuffled, whatever the sizes of files and aggregates suggest to the planner."""
    monkeypatch.setattr(audit, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr("foliolens.plans.lineage.fits_broadcast", lambda *_: False)
    frame = failing_combinations(*tables(rows, *odd_documents()))
    assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()


def test_one_text_in_most_rows(rows):
    made = [(i, "hot" if i % 3 else f"t{i}", "part", 7 if i % 3 else i) for i in range(3000)]
    texts = rows("doc_id long, text string, part string, key long", made)
    found = later_copies(texts.drop("text"), texts)
    assert found.columns == ["doc_id", "part", "key"]
    assert sorted(r.doc_id for r in found.collect()) == [i for i in range(2, 3000) if i % 3]


def test_empty_tables(rows):
    a, b = tables(rows, [], [])
    assert audit_filters(a, b).collect() == []
    c, _ = tables(rows, [(1, "a", None)], [])
    got = audit_filters(c, b).collect()
    assert len(got) == 600 and {(r.part, r.good_lost) for r in got} == {("", 0)}
    assert interactions(failing_combinations(c, b)).filter("step = 1 and filter_order = 'ABCDE'").first().removed == 1
