from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from foliolens.llm.packing import END, pack_documents, plan_patterns
from foliolens.llm.queries import QUERIES
from tests.conftest import FOLDER


def check(docs, pieces):
    """Every id once, right checksums, no gaps, at most 1024 ids; returns the share of padding."""
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*slow.encode(t or "", add_special_tokens=False).ids, END] for d, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for d, found in by_doc.items():
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids[d]))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[d][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids[d])
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    used = sum(map(len, ids.values()))
    return 1 - used / (1024 * len(by_sequence))


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert check(docs, QUERIES["op9_packing"](spark, FOLDER).collect()) < 0.03


def test_odd_rows(rows):
    texts = [None, "", "a b", "a b", "x " * 5000, "<|endoftext|> mark", "é中\n" * 700, "word " * 1023]
    docs = list(enumerate(texts))
    frame = rows("doc_id long, text string, length int, rank int", [(d, t, 1, None) for d, t in docs])
    check(docs, pack_documents(frame).collect())


def test_empty_table(rows):
    assert pack_documents(rows("doc_id long, text string", [])).collect() == []


def test_patterns_place_every_piece_and_waste_little():
    histogram = {n: 1 + (n * 7919) % 400 for n in range(1, 129)} | {256: 5000}
    plan, total = plan_patterns(histogram, 256), Counter()
    spans = defaultdict(list)
    for length, first, end, *_ in plan:
        spans[length].append((first, end))
        total[length] += end - first
    assert dict(total) == histogram
    for found in spans.values():
        found.sort()
        assert found[0][0] == 0 and all(a[1] == b[0] for a, b in zip(found, found[1:]))
    sequences = max(s + (end - first) // k for _, first, end, k, s, _ in plan)
    assert sequences <= 1.01 * sum(n * k for n, k in histogram.items()) / 256
