from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from foliolens.llm.hilbert import _text_cuts, curve_index, hilbert_shards, write_shards
from foliolens.llm.queries import QUERIES
from tests.conftest import FOLDER


def test_curve_visits_every_cell_by_single_steps():
    for d, bits in ((2, 3), (3, 2), (3, 4)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        order = curve_index(cells, bits)
        assert sorted(order) == list(range(len(cells)))
        path = cells[np.argsort(order)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(docs, got, shards=16):
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in docs)
    text = dict(docs)
    slots = defaultdict(list)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(counts) == len(got) and max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in got)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(docs, QUERIES["op8_hilbert_sharding"](spark, FOLDER).collect())


def test_odd_rows(rows):
    schema = "doc_id long, text string, lang string, source string, rank int, _at int"
    docs = [(1, None), (2, ""), (3, "x" * 100_000), (4, "é"), (4, "é"), (5, "b"), (6, "b")]
    made = [(d, t, None if d == 1 else "l%d" % (d % 2), None if d > 4 else "s", 0, 0) for d, t in docs]
    check(docs, hilbert_shards(rows(schema, made)).collect())
    assert hilbert_shards(rows(schema, [])).collect() == []


def test_files_hold_the_documents_in_order(spark, rows, tmp_path):
    made = [(i, "t" * i, "en", f"s{i % 5}", i) for i in range(50)]
    write_shards(rows("doc_id long, text string, lang string, source string, n_chars long", made), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(i, "t" * i) for i in range(50)]
    assert Counter(r.shard for r in back.collect()) == {0: 13, 1: 12, 2: 13, 3: 12}


def test_sources_with_a_long_common_beginning_are_told_apart(rows):
    made = [(i, "t", "en", f"https://www.example.org/a/{i * 37 % 320:04d}") for i in range(320)]
    got = hilbert_shards(rows("doc_id long, text string, lang string, source string", made)).collect()
    check([(d, t) for d, t, _, _ in made], got)
    sources = defaultdict(list)
    for r in got:
        sources[r.shard].append(made[r.doc_id][3])
    ranges = sorted((min(v), max(v)) for v in sources.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # each shard's file covers sources of its own


def test_text_quantiles_weigh_values_by_their_rows(rows):
    draw = random.Random(3)
    values = draw.choices([None, "a", "https://b", "https://c", "é"] + [f"https://u/{i}" for i in range(30)], weights=[8, 30, 3, 1, 5] + [1] * 30, k=600)
    steps = [i / 16 for i in range(1, 16)]
    ordered = sorted(values, key=lambda v: (v is not None, (v or "").encode()))
    want = {ordered[math.ceil(s * len(values)) - 1] for s in steps}
    got = _text_cuts(rows("v string, n int", [(v, 0) for v in values]), "v", steps)
    assert len(got) == len(want) and set(got) == want
    assert _text_cuts(rows("v string", []), "v", steps) == []
