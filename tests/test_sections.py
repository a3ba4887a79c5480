from __future__ import annotations

import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from foliolens.operators import ranking, refine
from foliolens.operators import relevance as rv
from foliolens.operators import sections as sc
from foliolens.plans import ranking_flow

BLOCK = "doc_id long, block_idx int, text string, font_size double, page int"


def best_borders(sizes):
    """Brute force over cut points of the sorted distinct sizes."""
    distinct = sorted(set(sizes))
    if len(distinct) <= 3:
        return distinct[-1], distinct[max(len(distinct) - 2, 0)]

    def cost(low, high):
        group = [s for s in sizes if low <= s and (high is None or s < high)]
        middle = sum(group) / len(group)
        return sum((s - middle) ** 2 for s in group)

    pairs = itertools.combinations(distinct[1:], 2)
    _, first, second = min((round(cost(0, a) + cost(a, b) + cost(b, None), 6), a, b) for a, b in pairs)
    return second, first


@pytest.mark.parametrize("kinds", [1, 2, 3, 4, 9, 30])
def test_size_borders_equal_brute_force(rows, kinds):
    rng = random.Random(kinds)
    data, expected = [], {}
    for d in range(8):
        pool = rng.sample([8 + 0.25 * i for i in range(80)], kinds)
        sizes = pool + [rng.choice(pool) for _ in range(20)]
        data += [(d, i, "t", s, 1) for i, s in enumerate(sizes)]
        expected[d] = best_borders(sizes)
    got = {r.doc_id: (r.h1_from, r.h2_from) for r in sc.size_borders(rows(BLOCK, data)).collect()}
    assert got == expected


def test_long_histograms_equal_brute_force_also_with_ties(rows):
    """Evenly spaced sizes tie; whole numbers keep the brute force exact."""
    data, expected = [], {}
    for d, step in ((1, 1), (2, 2)):
        sizes = [10 + step * i for i in range(600)]
        data += [(d, i, "t", float(x), 1) for i, x in enumerate(sizes)]
        total = [0]
        for x in sizes:
            total.append(total[-1] + x)
        spread = lambda i, j: -((total[j] - total[i]) ** 2) / (j - i)  # noqa: E731  but for the squares, which all pairs share
        _, first, second = min((round(spread(0, i) + spread(i, j) + spread(j, 600), 4), i, j) for i in range(1, 599) for j in range(i + 1, 600))
        expected[d] = (sizes[second], sizes[first])
    got = {r.doc_id: (r.h1_from, r.h2_from) for r in sc.size_borders(rows(BLOCK, data)).collect()}
    assert got == expected


def test_levels_and_slices(rows):
    blocks = rows(
        BLOCK,
        [(1, 0, "before", 9.0, 1), (1, 1, "Head  one", 20.0, 1), (1, 2, "b", 9.0, 1), (1, 3, "c", 9.0, 2), (1, 4, "Two", 14.0, 2), (2, 0, "x", 9.0, 1)],
    )
    levelled = sc.with_levels(blocks)
    assert {(r.doc_id, r.block_idx): r.level for r in levelled.collect()} == {
        (1, 0): "H3", (1, 1): "H1", (1, 2): "H3", (1, 3): "H3", (1, 4): "H2", (2, 0): "H1",
    }
    cut = sc.slice_sections(levelled, F.col("level") != "H3").orderBy("doc_id", "section_idx").collect()
    assert [(r.doc_id, r.section_idx, r.page, r.title, r.text, r.start_idx, r.end_idx) for r in cut] == [
        (1, 0, 1, "Head one", "Head  one b c", 1, 3), (1, 1, 2, "Two", "Two", 4, 4), (2, 0, 1, "x", "x", 0, 0),
    ]
    each = sc.block_sections(levelled)
    assert each.count() == 6 and {"section_idx", "title", "level", "page"} <= set(each.columns)


SECTION = "doc_id long, section_idx int, collection string, text string"


def some_sections(seed=3):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "x", "Été", "n_1", "the", "the"]
    data = []
    for d in range(4):
        for s in range(d * 3 + 1):
            data.append((d, s, f"c{d % 2}", " ".join(rng.choice(words) for _ in range(rng.randrange(12)))))
    data.append((9, 0, "c1", "! ?"))
    return data


def plain_scores(data, queries):
    tokenise = lambda t: re.findall(r"\w\w+", t.lower())
    scores = {}
    for d in {r[0] for r in data}:
        docs = {r[1]: tokenise(r[3]) for r in data if r[0] == d}
        query = tokenise(queries[next(r[2] for r in data if r[0] == d)])
        df = {t: sum(t in ws for ws in docs.values()) for ws in docs.values() for t in ws}
        length = math.sqrt(sum(query.count(t) ** 2 for t in set(query)))
        for s, ws in docs.items():
            w = {t: ws.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in set(ws)}
            norm = math.sqrt(sum(v * v for v in w.values()))
            lexical = sum(w.values()) / norm if norm else 0.0
            cosine = sum(query.count(t) * v for t, v in w.items()) / norm / length if norm else 0.0
            scores[(d, s)] = (cosine, lexical, 0.6 * cosine + 0.4 * lexical)
    return scores


@pytest.mark.parametrize("per_chunk", [1, 2, 256])
def test_scores_across_chunks(rows, per_chunk):
    data, queries = some_sections(), {"c0": "the beta the", "c1": "gamma"}
    asked = rows("collection string, query string", list(queries.items()))
    got = rv.section_scores(rows(SECTION, data), asked, ["collection"], per_chunk=per_chunk).collect()
    expected = plain_scores(data, queries)
    assert len(got) == len(data) == len(expected)
    for r in got:
        assert (r.cosine, r.lexical, r.score) == pytest.approx(expected[(r.doc_id, r.section_idx)])
    weights = rv.tfidf(rows(SECTION, data), per_chunk=per_chunk).groupBy("doc_id", "section_idx").agg(
        F.sum(F.col("weight") * F.col("weight")).alias("one")
    )
    assert all(r.one == pytest.approx(1) for r in weights.collect())


def test_hot_query_key_without_broadcast(rows, monkeypatch):
    from foliolens.plans import lineage

    monkeypatch.setattr(lineage, "fits_broadcast", lambda *_: False)
    data, queries = some_sections(), {"c0": "the beta the", "c1": "gamma"}
    asked = rows("collection string, query string", list(queries.items()))
    got = rv.section_scores(rows(SECTION, data), asked, ["collection"], per_chunk=2).collect()
    expected = plain_scores(data, queries)
    assert {(r.doc_id, r.section_idx): pytest.approx(r.score) for r in got} == {k: v[2] for k, v in expected.items()}


def test_ranks(rows):
    rng = random.Random(8)
    data = [(d, s, rng.choice([0.0, 0.5, 1.0, rng.random(), rng.random() * 3])) for d in range(3) for s in range(40 * d + 1)]
    scored = rows("doc_id long, section_idx int, score double", data)
    ranked = {(r.doc_id, r.section_idx): r.importance_rank for r in ranking.rank_sections(scored).collect()}
    top = {(r.doc_id, r.section_idx): r.importance_rank for r in rv.top_sections(scored).collect()}
    for d in range(3):
        order = sorted((r for r in data if r[0] == d), key=lambda r: (-round(r[2], 9), r[1]))
        assert [ranked[(d, r[1])] for r in order] == list(range(1, len(order) + 1))
        assert [top[(d, r[1])] for r in order[:5]] == list(range(1, min(5, len(order)) + 1))
    assert len(top) == 11


@pytest.mark.parametrize(
    "persona, job, query",
    [
        ("Sea captain", "cook a fish", "of the sea"),
        ("Baker", "A LOAF for ten", "of bread"),
        ("Clerk", "oven and flour", "of bread"),
        ("Clerk", "forms", "Clerk forms"),
    ],
)
def test_routes(spark, persona, job, query):
    assert spark.range(1).select(rv.route_query(F.lit(persona), F.lit(job), [(["sea"], "of the sea"), (["loaf", "flour"], "of bread")])).first()[0] == query


def refined(sections, **options):
    scored = rv.section_scores(sections, keep_terms=True).select("doc_id", "section_idx", "terms")
    chosen = sections.where("section_idx = 0").join(scored, ["doc_id", "section_idx"])
    return refine.refine(chosen, **options).first().refined_text


def test_refine_keeps_sentence_order_and_limit(rows):
    text = "Common words here. Rare zebra quagga. Words here. Unique okapi!"
    sections = rows(SECTION, [(1, 0, "c", text)] + [(1, i, "c", "common words here") for i in range(1, 6)])
    assert refined(sections, keep=2) == "Rare zebra quagga. Unique okapi!"
    assert refined(sections, keep=1, max_chars=10) == "Rare zebra"
    assert refined(rows(SECTION, [(2, 0, "c", "...")])) == ""


def test_flow_gives_top_sections_of_every_document(rows):
    data = some_sections()
    sections = rows(SECTION, data).withColumn("page", F.lit(0))
    configs = rows("collection string, persona string, job string", [("c0", "the", "beta"), ("c1", "gamma", "")])
    best = ranking_flow.best_sections(sections, configs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in best} == {d: min(5, sum(r[0] == d for r in data)) for d in {r[0] for r in data}}


def test_the_tasks_of_postings_grow_with_the_text(rows, monkeypatch):
    monkeypatch.setattr(rv, "BYTES_PER_TASK", 2_000, raising=False)
    text = " ".join(f"word{i}" for i in range(100))
    sections = rows("doc_id long, section_idx int, text string", [(d, 0, text) for d in range(200)] + [(200, 0, None)])
    weights = rv.term_weights(sections).select("doc_id", F.spark_partition_id().alias("task")).distinct().collect()
    held = {}
    for r in weights:
        held.setdefault(r["task"], set()).add(r["doc_id"])
    assert {d for h in held.values() for d in h} == set(range(201))
    assert max(len(h) for h in held.values()) < 20


def test_sections_joined_to_vectors_are_written_once(rows, monkeypatch):
    """What comes of a join of text and vectors is read several times, so it is kept with the cosine in place of the vectors."""
    kept, cut = [], rv.cut

    def noted(table):
        kept.append(table.columns)
        return cut(table)

    monkeypatch.setattr(rv, "cut", noted)
    sections = rows("doc_id long, section_idx int, c string, text string, embedding array<double>", [(1, 0, "a", "two words", [1.0, 0.0]), (1, 1, "a", None, [3.0, 4.0])])
    asked = rows("c string, query string, vector array<double>", [("a", "x", [1.0, 0.0])])
    scored = {r.section_idx: r for r in rv.section_scores(sections, asked, ["c"]).collect()}
    assert ["doc_id", "section_idx", "c", "text", "_between"] in kept
    assert scored[0].cosine == 1.0 and scored[1].cosine == pytest.approx(0.6) and scored[1].lexical == 0.0


def test_summaries_take_means_of_sentences(rows):
    """The flow keeps a mean for each sentence, not a map of the words of each section, and gives the summaries of the map."""
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "x", "delta", "ÉTÉ"]
    text = lambda: " ".join(rng.choice(words) + rng.choice(["", "", ".", "!?", " ."]) for _ in range(rng.randrange(25)))
    data = [(d, s, "c0", text()) for d in range(4) for s in range(6)] + [(4, 0, "c0", None), (4, 1, "c0", "..."), (4, 2, "c0", "one. two. one")]
    data += [(5, 0, "c0", "alpha beta. delta"), (5, 0, "c0", "beta. beta. gamma gamma. x"), (5, 1, "c0", "beta")]
    sections = rows(SECTION, data).withColumn("page", F.lit(0))
    for per_chunk in (2, 256):
        maps = rv.section_scores(sections, keep_terms=True, per_chunk=per_chunk).select("doc_id", "section_idx", "terms")
        means = rv.section_scores(sections, keep_sentences=True, per_chunk=per_chunk).select("doc_id", "section_idx", "sentences")
        texts = sections.select("doc_id", "section_idx", "text", F.xxhash64("text").alias("text_hash"))
        old, new = (sorted(map(str, refine.refine(texts.join(x, ["doc_id", "section_idx"])).select("doc_id", "section_idx", "refined_text").collect())) for x in (maps, means))
        assert old == new and len(new) == len(data)
    configs = rows("collection string, persona string, job string", [("c0", "the", "beta")])
    plan = ranking_flow.best_sections(sections, configs)._jdf.queryExecution().executedPlan().toString()
    assert "map_from_entries" not in plan
