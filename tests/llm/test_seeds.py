from __future__ import annotations

import itertools
import math
import random
import re

import numpy as np

from foliolens.llm import seeds
from foliolens.llm.kernels import word_hashes, words
from foliolens.llm.queries import QUERIES
from foliolens.llm.seeds import Items, MASKS, SHORTEST, TOLERANCE, WINDOW, decontaminate, find_overlaps
from tests.conftest import FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, item):
    """Covered word spans per alignment, by comparing every window of every alignment."""
    a, b, spans = low(text), low(item), []
    if len(b) < SHORTEST:
        return spans
    n = min(WINDOW, len(b))
    need = n - math.floor(TOLERANCE * n + 1e-9)
    for shift in range(1 - len(b), len(a)):
        covered = set()
        low_, high = max(0, shift), min(len(a), shift + len(b))
        same = [a[i] == b[i - shift] for i in range(low_, high)]

        def cover(i, k, need):
            if i >= 0 and i + k <= len(same) and sum(same[i : i + k]) >= need:
                covered.update(range(low_ + i, low_ + i + k))

        for i in range(len(same)):
            cover(i, n, need)
            if n >= 13:
                cover(i, 13, 13)
        for k in range(13, n):
            if shift < 0:
                cover(0, k, max(13, math.ceil(0.8 * k - 1e-9)))
            if shift + len(b) > len(a):
                cover(len(same) - k, k, max(13, math.ceil(0.8 * k - 1e-9)))
        for _, run in itertools.groupby(enumerate(sorted(covered)), lambda x: x[1] - x[0]):
            run = [x for _, x in run]
            spans.append((run[0], run[-1] + 1))
    return spans


def test_masks_find_every_window_with_a_fifth_replaced():
    for n in range(SHORTEST, WINDOW + 1):
        laid = [
            sum(1 << (s + i) for i, c in enumerate(m) if c == "1") for m in MASKS for s in range(n - len(m) + 1)
        ]
        for lost in itertools.combinations(range(n), math.floor(TOLERANCE * n + 1e-9)):
            gone = sum(1 << i for i in lost)
            assert any(not x & gone for x in laid), (n, lost)


def test_replaced_words_against_brute_force(rows):
    draw = random.Random(5)
    common = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(draw.choices(common, k=draw.randint(3, 40)))) for i in range(12)] + [(90, None), (91, ""), (92, "a b")]
    docs = []
    for d in range(60):
        text = draw.choices(common, k=draw.randint(0, 30)) + low(draw.choice(items[:12])[1]) + draw.choices(common, k=draw.randint(0, 30))
        for _ in range(draw.randint(0, 8)):
            text[draw.randrange(len(text))] = "Changed"
        docs.append((d, draw.choice([" ", "\n", " \t "]).join(text).upper() if d % 3 else " ".join(text)))
    docs += [(60, None), (61, ""), (62, " \n"), (63, docs[5][1]), (63, docs[5][1])]
    frame = rows("doc_id long, text string, item_id int", [(*d, 0) for d in docs])
    bench = rows("item_id long, text string, doc_id int", [(*i, 0) for i in items])
    for block in (2_000_000, 60):
        got = sorted(
            (r.doc_id, sorted((h.item_id, h.first, h.end) for h in r.hits)) for r in find_overlaps(frame, bench, "hits", block).collect()
        )
        assert got == sorted((d, sorted((i, *s) for i, b in items for s in brute(t, b))) for d, t in docs)
    assert any(h for _, h in got) and any(not h for _, h in got)
    clean = decontaminate(frame.withColumnRenamed("item_id", "hits"), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, h in got if not h)
    assert clean.columns == ["doc_id", "text", "hits"]


def numbered(a, b):
    return [f"n{i}" for i in range(a, b)]


def test_runs_of_thirteen_and_windows_at_the_edges(rows):
    other = [f"x{i}" for i in range(40)]
    changed = [w if i != 7 else "other" for i, w in enumerate(numbered(80, 94))]
    docs = [
        other + numbered(30, 43) + other,  # a run of 13 words of a longer item
        other + numbered(30, 42) + other,  # 12 words
        changed + other,  # 13 of 14 words at the start of the document
        other + changed,  # at its end
        other + changed + other,  # the same inside
        numbered(0, 14) + ["more"] * 3,  # the start of the item is no cut
    ]
    frame = rows("doc_id long, text string", [(i, " ".join(d)) for i, d in enumerate(docs)])
    item = " ".join(numbered(0, 100))
    got = {r.doc_id: [(h.first, h.end) for h in r.hits] for r in find_overlaps(frame, rows("item_id long, text string", [(1, item)]), "hits").collect()}
    assert got == {0: [(40, 53)], 1: [], 2: [(0, 16)], 3: [(38, 54)], 4: [], 5: [(0, 17)]}  # a fifth of a window may differ
    assert got == {i: [s for s in brute(" ".join(d), item)] for i, d in enumerate(docs)}


def test_a_seed_that_is_in_every_item(rows, monkeypatch):
    phrase = "what is the answer"
    own = lambda i: " ".join(f"q{i}x{j}" for j in range(8))
    items = [(i, f"{phrase} {own(i)}") for i in range(300)] + [(5, f"{phrase} {own(5)}")]
    docs = [(1, f"{phrase} " * 500), (2, f"so {phrase} {own(17)} then"), (3, f"{phrase} nothing else {phrase} {own(5)}")]
    bench = rows("item_id long, text string", items)
    frame = rows("doc_id long, text string", docs)
    whole = {r.doc_id: [tuple(h) for h in r.hits] for r in find_overlaps(frame, bench, "hits").collect()}
    assert whole == {1: [], 2: [(17, 1, 13)], 3: [(5, 6, 18)] * 2}
    parts = Items([i for i, _ in items], [t for _, t in items])
    words_ = low(docs[1][1])
    raw = np.frombuffer(" ".join(words_).encode(), np.uint8)
    starts, ends, first = words(np.array([0, len(raw)]), raw)
    tokens = word_hashes(raw, starts, ends)
    found = parts.overlaps(tokens, first)
    monkeypatch.setattr(seeds, "_LAID", 50)  # many small steps give the same
    assert parts.overlaps(tokens, first) == found == {0: whole[2]}


def test_empty_tables(rows):
    docs, bench = rows("doc_id long, text string", [(1, "a " * 50)]), rows("item_id long, text string", [])
    assert [r.hits for r in find_overlaps(docs, bench, "hits").collect()] == [[]]
    assert find_overlaps(docs.limit(0), bench, "hits").collect() == []
    assert find_overlaps(docs.limit(0), rows("item_id long, text string", [(1, "a " * 9)]), "hits").collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    items = [low(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op6_decontamination"](spark, FOLDER).collect()}
    assert set(got) == {d.doc_id for d in docs}
    for d in docs:  # every whole item is found; a flagged text shares four words in a row with an item
        text = f" {' '.join(low(d.text))} "
        if any(len(i) >= SHORTEST and f" {' '.join(i)} " in text for i in items):
            assert got[d.doc_id].contaminated
        if got[d.doc_id].contaminated:
            assert got[d.doc_id].longest >= SHORTEST and got[d.doc_id].item_ids
    assert 0 < sum(r.contaminated for r in got.values()) < len(docs) / 4


def test_a_text_longer_than_a_chunk(rows):
    item = numbered(0, 40)
    long_ = ["filler"] * 300_000
    docs = [(1, " ".join(long_ + item)), (2, " ".join(item + long_)), (3, " ".join(long_)), (1, " ".join(long_ + item)), (None, " ".join(item))]
    got = find_overlaps(rows("doc_id long, text string", docs), rows("item_id long, text string", [(9, " ".join(item))]), "hits")
    at = [(r.doc_id, [(h.first, h.end) for h in r.hits]) for r in got.collect()]
    assert sorted(h for d, h in at if d == 1) == [[(300_000, 300_040)]] * 2
    assert sorted((d or 0, h) for d, h in at if d != 1) == [(0, [(0, 40)]), (2, [(0, 40)]), (3, [])]
