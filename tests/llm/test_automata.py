from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from foliolens.llm.automata import FRAGMENTS, WINDOW, Automaton, _fragments, measure, substring_dedup
from foliolens.llm.queries import QUERIES
from foliolens.llm.repeats import anchors, candidates, sliding_argmin, union_spans
from tests.conftest import FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    least, out = {}, []
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - WINDOW + 1):
            key = tuple(w[i : i + WINDOW])
            least[key] = min(d, least.get(key, d))
    for d, w in split:
        gone = set()
        for i in range(len(w) - WINDOW + 1):
            if least[tuple(w[i : i + WINDOW])] < d:
                gone |= set(range(i, i + WINDOW))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(frame):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def test_sliding_argmin():
    draw = np.random.default_rng(1)
    h = draw.integers(0, 50, 500).astype(np.uint64) << np.uint64(40)
    for width in (1, 2, 3, 7, 8, 9, 100):
        want = [i + int(np.argmin(h[i : i + width])) for i in range(len(h) - width + 1)]
        assert list(sliding_argmin(h, width)) == want
    assert len(sliding_argmin(h[:3], 5)) == 0


def test_every_window_has_one_anchor_inside():
    draw = np.random.default_rng(2)
    grams, first = draw.integers(0, 2**63, 300).astype(np.uint64), np.array([0, 0, 40, 52, 60, 304])
    text, at, key, least, most = anchors(grams, 5, first, 13)
    starts = sorted((t, a - x) for t, a, lo, hi in zip(text, at, least, most) for x in range(lo, hi + 1))
    want = sorted((t, s) for t in range(5) for s in range(first[t + 1] - first[t] - 12))
    assert starts == want and most.max() <= 8
    assert (grams[first[text] + at] == key).all()


def test_automaton_knows_the_smallest_document_of_every_substring():
    draw = random.Random(4)
    for _ in range(60):
        texts = [(draw.randrange(50), [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(1, 25))]) for _ in range(6)]
        tree = Automaton()
        for d, t in texts:
            tree.add(t, d)
        tree.finish()
        for n in (1, 3, 5):
            for d, t in texts + [(99, [b"a", b"z", b"b", b"c", b"a", b"a"])]:
                want = [
                    i for i in range(len(t) - n + 1)
                    if any(e < d and any(u[j : j + n] == t[i : i + n] for j in range(len(u) - n + 1)) for e, u in texts)
                ]
                assert tree.covered(t, d, n) == want


def test_union_spans():
    a, b = union_spans(np.array([5, 0, 7, 20]), np.array([8, 2, 9, 21]))
    assert list(zip(a, b)) == [(0, 2), (5, 9), (20, 21)]


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "W1"]
    passages = [draw.choices(vocabulary, k=draw.randint(8, 60)) for _ in range(12)]
    docs = []
    for d in range(n):
        text = []
        for _ in range(draw.randint(0, 5)):
            passage = list(draw.choice(passages))
            if draw.random() < 0.5:
                passage[draw.randrange(len(passage))] = f"x{draw.randrange(9)}"
            text += draw.choices(vocabulary, k=draw.randint(0, 12)) + passage
        docs.append((draw.randrange(10**6) * n + d, draw.choice([" ", "\n", " \t"]).join(text)))
    return docs + [(docs[0][0] + 1_000_000_000, docs[0][1]), (docs[1][0] + 1_000_000_001, docs[1][1])]


def test_against_brute_force(rows):
    docs = corpus(1, 150) + [(2_000_000_000, None), (2_000_000_001, ""), (2_000_000_002, "a " * 30), (2_000_000_003, "a " * 30), (2_000_000_004, "b")]
    frame = rows("doc_id long, text string, n int, digest string", [(*d, 0, "") for d in docs])
    assert got(substring_dedup(frame)) == brute(docs)


def test_common_passage_is_split_over_targets(rows):
    draw = random.Random(7)
    passage = [f"p{i}" for i in range(24)]
    docs = []
    for d in range(2400):
        around = [f"u{draw.randrange(30)}" if draw.random() < 0.7 else f"v{d}" for _ in range(20)]
        cut = draw.randrange(20)
        docs.append((draw.randrange(10**6) * 2400 + d, " ".join(around[:cut] + passage + around[cut:] + (passage if d % 9 == 0 else []))))
    frame = rows("doc_id long, text string", docs)
    assert got(substring_dedup(frame)) == brute(docs)
    sent = candidates(frame, measure, False, "words")[2].mapInArrow(_fragments(50), FRAGMENTS).filter("text is not null")
    sizes = [r["count"] for r in sent.groupBy("target").count().collect()]
    assert max(sizes) < 1000


def test_texts(rows):
    a = " ".join(f"w{i}" for i in range(20))
    frame = rows("doc_id long, text string", [(1, a), (2, f"x {a} y"), (3, a), (4, "q")])
    out = {r.doc_id: r.kept_text for r in substring_dedup(frame, texts=True).collect()}
    assert out == {1: None, 2: "x y", 3: "", 4: None}


def test_empty_and_null_ids(rows):
    assert substring_dedup(rows("doc_id long, text string", [])).collect() == []
    a = " ".join(f"w{i}" for i in range(20))
    out = substring_dedup(rows("doc_id long, text string", [(None, a), (None, None), (7, a)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in out) == [("7", 0), ("None", 0), ("None", 0)]


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op10_substring_dedup"](spark, FOLDER)) == brute(docs)
