from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import groupby

import numpy as np

from foliolens.llm import suffixes
from foliolens.llm.queries import QUERIES
from foliolens.llm.repeats import candidates
from tests.conftest import FOLDER


def brute(docs, window=400):
    seen = Counter()
    for _, t in docs:
        raw = (t or "").encode()
        seen.update(raw[i : i + window] for i in range(len(raw) - window + 1))
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - window + 1):
            if seen[raw[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), int(gone.sum()), sum(k for k, _ in groupby(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(frame):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


def test_common_prefix():
    assert suffixes.common_prefix(b"abcd", b"abce") == 3 and suffixes.common_prefix(b"", b"a") == 0
    assert suffixes.common_prefix(b"abc", b"abcd", 2) == 3 and suffixes.common_prefix(b"\0\0a", b"\0\0b") == 2
    assert suffixes.common_prefix(b"ab\0x", b"ab\1x", 1) == 2


def test_loser_tree_merges_and_knows_common_prefixes():
    draw = random.Random(1)
    for count in (1, 2, 3, 5, 8):
        runs = []
        for _ in range(count):
            run = sorted(bytes(draw.choices(b"ab\0", k=draw.randint(0, 12))) for _ in range(draw.randint(0, 30)))
            runs.append((run, suffixes.neighbours(run).tolist()))
        out = list(suffixes.LoserTree(runs))
        strings = [runs[r][0][i] for r, i, _ in out]
        assert strings == sorted(s for run, _ in runs for s in run)
        assert [p for _, _, p in out] == suffixes.neighbours(strings).tolist()


def test_runs_survive_front_coding():
    strings = sorted([b"abc", b"abd", b"", b"zz", b"abd"])
    lefts, numbers = [b"1", b"", b"22", b"3", b"x"], np.arange(5)
    back = suffixes.decode(suffixes.front_code(strings, suffixes.neighbours(strings), lefts, numbers, -numbers))
    assert back[0] == strings and back[1] == suffixes.neighbours(strings).tolist() and back[2] == lefts
    assert back[3].tolist() == [numbers.tolist(), (-numbers).tolist()]


def corpus(seed, n):
    draw = random.Random(seed)
    letters = "abcdefgh é\n"
    passages = ["".join(draw.choices(letters, k=draw.choice([150, 395, 400, 401, 450, 900, 1500]))) for _ in range(10)]
    docs = []
    for d in range(n):
        text = ""
        for _ in range(draw.randint(0, 4)):
            passage = list(draw.choice(passages))
            for _ in range(draw.choice([0, 0, 1, 2])):
                passage[draw.randrange(len(passage))] = draw.choice("XYZ")
            text += "".join(draw.choices(letters, k=draw.randint(0, 80))) + "".join(passage)
        docs.append((d, text))
    return docs


def test_against_brute_force(rows):
    docs = corpus(3, 120)
    docs += [(500, None), (501, ""), (502, "z" * 3000), (503, "ab" * 900), (504, docs[4][1]), (505, docs[5][1]), (506, "q" * 399), (507, "q" * 399)]
    frame = rows("doc_id long, text string, first int, digest string", [(*d, 0, "") for d in docs])
    assert got(suffixes.suffix_dedup(frame)) == brute(docs)


def test_common_passage_is_split_over_targets(rows):
    draw = random.Random(11)
    passage, edges = "".join(draw.choices("abcdef", k=430)), ["".join(draw.choices("gh", k=60)) for _ in range(40)]
    docs = []
    for d in range(2200):
        left, right = ("".join(draw.choices("ijkl", k=30)) + draw.choice(edges)[: draw.randrange(60)] for _ in range(2))
        docs.append((draw.randrange(10**6) * 2200 + d, left + passage + right[::-1]))
    frame = rows("doc_id long, text string", docs)
    assert got(suffixes.suffix_dedup(frame)) == brute(docs)
    sent = candidates(frame, suffixes.measure, True, "bytes")[2].mapInArrow(suffixes._runs(50), suffixes.RUNS)
    sizes = Counter()
    for r in sent.collect():
        sizes[r.target] += sum(len(x) for x in r if isinstance(x, bytes | bytearray))
    assert max(sizes.values()) < sum(sizes.values()) / 5


def test_slices_keep_groups_whole():
    group = np.repeat([3, 4, 6, 7, 9], [2, 3, 9, 1, 1])
    assert suffixes.slices(group, 5) == [5, 14] and suffixes.slices(group, 99) == [] and suffixes.slices(group[:0], 5) == []


def test_bytes(rows):
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdef", k=500))
    frame = rows("doc_id long, text string", [(1, f"x{passage}y"), (2, f"{passage}é"), (3, "short"), (4, passage[:399])])
    out = {r.doc_id: r.kept_bytes for r in suffixes.suffix_dedup(frame, texts=True).collect()}
    assert {d: None if b is None else bytes(b) for d, b in out.items()} == {1: b"xy", 2: "é".encode(), 3: None, 4: None}


def test_empty_and_null_ids(rows):
    assert suffixes.suffix_dedup(rows("doc_id long, text string", [])).collect() == []
    out = suffixes.suffix_dedup(rows("doc_id long, text string", [(None, "a" * 10 + "b" * 400), (7, "a" * 10 + "b" * 400), (8, "c")])).collect()
    assert sorted((str(r.doc_id), r.n_removed, r.n_spans) for r in out) == [("7", 410, 1), ("8", 0, 0), ("None", 410, 1)]


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op1_suffix_dedup"](spark, FOLDER)) == brute(docs)
