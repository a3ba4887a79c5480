"""Queries of the text-preparation operators over the given tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliolens.llm.audit import audit_filters
from foliolens.llm.automata import substring_dedup
from foliolens.llm.blocks import extract_main_text
from foliolens.llm.exact import exact_dedup, halves
from foliolens.llm.hilbert import hilbert_shards
from foliolens.llm import language, quality
from foliolens.llm.jaccard import jaccard_components
from foliolens.llm.lines import line_dedup
from foliolens.llm.middle import fill_in_middle, restore
from foliolens.llm.packing import pack_documents
from foliolens.llm.seeds import find_overlaps
from foliolens.llm.suffixes import suffix_dedup
from foliolens.sources.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents"))


@query(
    "op2_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
               FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(*halves(read(spark, sf_dir, "documents")))


@query("op7_ngram_jaccard")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


@query("op8_hilbert_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(read(spark, sf_dir, "documents"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", language.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


@query(
    "op4_line_dedup",
    r"""
    WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    lines AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM texts),
    sets AS (SELECT doc_id, line_no, doc_id * 10000000 + line_no AS place,
                    list_sort(list_distinct(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS t FROM lines),
    firsts AS (SELECT t, len(t) AS size, min(place) AS place FROM sets WHERE len(t) > 0 GROUP BY t),
    words AS (SELECT place, size, unnest(t) AS w FROM firsts),
    counts AS (SELECT w, count(*) AS n FROM words GROUP BY w),
    ranks AS (SELECT place, size, w, row_number() OVER (PARTITION BY place ORDER BY n, w) AS i FROM words JOIN counts USING (w)),
    prefixes AS (SELECT place, size, w FROM ranks WHERE i <= size - (size * 80 + 99) // 100 + 1),
    pairs AS (SELECT DISTINCT a.place AS x, b.place AS y FROM prefixes a JOIN prefixes b ON a.w = b.w AND a.place < b.place
              WHERE least(a.size, b.size) * 100 >= greatest(a.size, b.size) * 80),
    links AS (SELECT x, y FROM pairs JOIN firsts a ON a.place = x JOIN firsts b ON b.place = y
              WHERE len(list_intersect(a.t, b.t)) * 180 >= 80 * (a.size + b.size)),
    earliest AS (SELECT y AS place, min(x) AS x FROM links GROUP BY y),
    found AS (SELECT t, least(f.place, coalesce(x, f.place)) AS first FROM firsts f LEFT JOIN earliest e ON f.place = e.place),
    marked AS (SELECT doc_id, line_no, coalesce(first < place, false) AS gone FROM sets s LEFT JOIN found f ON s.t = f.t)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(line_no, ',' ORDER BY line_no) FILTER (gone), '') AS removed_lines
    FROM marked GROUP BY doc_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return language.identify(rows, language.fit(docs)).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it overlaps the benchmark, the items, the number of spans and the longest in words."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_overlaps(docs, read(spark, sf_dir, "benchmark"), "hits")
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.array_sort(F.array_distinct("hits.item_id")).alias("item_ids"),
        F.size("hits").cast("long").alias("n_spans"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["end"] - h["first"])), F.lit(0)).cast("long").alias("longest"),
    )


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"))


@query(
    "op11_filter_audit",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    first AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
    w AS (SELECT d.*, first.low, list_filter(string_split_regex(d.t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d JOIN first USING (t)),
    l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY doc_id),
    f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
            + (CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
            + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN low < w.doc_id THEN 16 ELSE 0 END) AS bits
          FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
    c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
    k(f, l) AS (VALUES (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D'), (4, 'E')),
    o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.f, b.f, c.f, d.f, e.f] AS fs
          FROM k a, k b, k c, k d, k e
          WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
    s AS (SELECT filter_order, i AS step, 1 << fs[i] AS bit, coalesce(list_sum(list_transform(fs[1:i-1], lambda x: 1 << x)), 0)::BIGINT AS before
          FROM o, range(1, 6) r(i)),
    x AS (SELECT part, filter_order, step::INTEGER AS step, bit,
            coalesce(sum(n) FILTER (bits & (bit | before) = 0), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (bits & bit <> 0 AND bits & before = 0), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (bits & bit <> 0 AND bits & before <> 0), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (bits = bit), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (bits & bit <> 0 AND bits & before = 0), 0)::BIGINT AS good_lost,
            coalesce(sum(toxic) FILTER (bits & bit <> 0 AND bits & before = 0), 0)::BIGINT AS toxic_lost
          FROM c, s GROUP BY 1, 2, 3, 4)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM x
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query(
    "op12_fill_in_middle",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
                 list_transform(range(4), lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT) AS hs FROM d),
    c AS (SELECT doc_id, t, us, len(us) AS n, least(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) AS a,
                 greatest(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR hs[3] % 100 >= 50 THEN 'plain'
                      WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(us[1:a], ''), '') AS x, coalesce(array_to_string(us[a + 1:b], ''), '') AS m,
                 coalesce(array_to_string(us[b + 1:], ''), '') AS y FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || y || '<M>' || m
                            ELSE '<S>' || y || '<P>' || x || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(restore("output", "form"), 256).alias("restored_sha256"),
    )


@query("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))
