"""Tokens, TF-IDF, cosine and hybrid scores, rankings, font levels and section slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliolens.catalog.base import CONFIGS, LINES, Tables, query, sql_strip
from foliolens.catalog.layout import SPANS
from foliolens.functions.vectors import normalised
from foliolens.operators import lines as ln
from foliolens.operators import ranking
from foliolens.operators import relevance as rv
from foliolens.operators import sections as sc
from foliolens.operators.encoding import Encoder, cosine_to, encode
from foliolens.plans import ranking_flow as flow


# Words in a persona and job, and the query each group of them stands for.
ROUTES = [
    (["tour", "journey"], "routes, sights and places to stay on a journey"),
    (["menu", "dish"], "dishes and what goes into them"),
    (["form", "signature"], "filling in, signing and sending forms"),
]


def _route_case(persona: str, job: str) -> str:
    text = f"({persona} || ' ' || {job})"
    parts = []
    for words, query_text in ROUTES:
        hits = " OR ".join(f"contains(lower({text}), '{w}')" for w in words)
        parts.append(f"WHEN {hits} THEN '{query_text}'")
    return "CASE " + " ".join(parts) + f" ELSE {text} END"


PERSONAS = ["Tour guide", "Menu planner", "Clerk of FORMS"]


@query(
    "persona_route",
    f"""SELECT conv_id, turn, {_route_case('persona', 'job')} AS query
        FROM (SELECT conv_id, turn, text AS job,
                     CASE conv_id % 4 WHEN 0 THEN '{PERSONAS[0]}' WHEN 1 THEN '{PERSONAS[1]}' WHEN 2 THEN '{PERSONAS[2]}'
                                      ELSE 'Reader' END AS persona
              FROM conversations WHERE role = 'user')""",
)
def persona_route(t: Tables):
    """Queries of all user turns; a quarter of the conversations has no persona with a route."""
    turns = t.read("conversations").where("role = 'user'")
    kind = F.col("conv_id") % 4
    persona = F.when(kind == 0, PERSONAS[0]).when(kind == 1, PERSONAS[1]).when(kind == 2, PERSONAS[2]).otherwise("Reader")
    return turns.select("conv_id", "turn", rv.route_query(persona, F.col("text"), ROUTES).alias("query"))


TERMS = (
    LINES
    + r""",
tok AS (
  SELECT doc_id, line_idx AS section_idx, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM lines
),
tf AS (SELECT doc_id, section_idx, term, count(*) AS tf FROM tok GROUP BY ALL),
df AS (SELECT doc_id, term, count(*) AS df FROM tf GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY ALL),
weights AS (
  SELECT tf.*, df, n, tf * (ln((1 + n)::DOUBLE / (1 + df)::DOUBLE) + 1) AS raw
  FROM tf JOIN df USING (doc_id, term) JOIN size USING (doc_id)
),
lexical AS (
  SELECT l.doc_id, l.line_idx AS section_idx, l.source AS collection, l.page, l.text, coalesce(total / length, 0) AS lexical,
         coalesce(length, 0) AS length
  FROM lines l LEFT JOIN (SELECT doc_id, section_idx, sum(raw) AS total, sqrt(sum(raw * raw)) AS length FROM weights
                          GROUP BY ALL) w ON l.doc_id = w.doc_id AND l.line_idx = w.section_idx
)"""
)

SCORES = (
    TERMS
    + ","
    + CONFIGS
    + rf""",
query_tokens AS (
  SELECT collection, unnest(regexp_extract_all(lower(query), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term
  FROM (SELECT collection, {_route_case('persona', 'job')} AS query FROM configs)
),
query_tf AS (SELECT collection, term, count(*) AS qtf FROM query_tokens GROUP BY ALL),
query_norm AS (SELECT collection, sqrt(sum(qtf * qtf)) AS qnorm FROM query_tf GROUP BY ALL),
dots AS (
  SELECT w.doc_id, w.section_idx, sum(w.raw * q.qtf) AS dot
  FROM weights w JOIN (SELECT doc_id, source AS collection FROM documents) d USING (doc_id)
  JOIN query_tf q ON q.collection = d.collection AND q.term = w.term GROUP BY ALL
),
scored AS (
  SELECT *, 0.6::DOUBLE * cosine + 0.4::DOUBLE * lexical AS score
  FROM (SELECT l.*, coalesce(dot / (length * qnorm), 0) AS cosine
        FROM lexical l LEFT JOIN dots USING (doc_id, section_idx) LEFT JOIN query_norm USING (collection))
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, section_idx)::INTEGER AS importance_rank
  FROM scored
)"""
)


@query("tokens", "WITH " + TERMS + " SELECT doc_id, section_idx, term FROM tok")
def tokens(t: Tables):
    return rv.section_tokens(t.sections)


@query("tfidf", "WITH " + TERMS + """ SELECT doc_id, section_idx, term, tf, df,
       round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id, section_idx)), 5) AS weight FROM weights""")
def tfidf(t: Tables):
    return rv.tfidf(t.sections).withColumn("weight", F.round("weight", 5))


@query("lexical_score", "WITH " + TERMS + " SELECT doc_id, section_idx, round(lexical, 5) AS lexical FROM lexical")
def lexical_score(t: Tables):
    return rv.section_scores(t.sections).select("doc_id", "section_idx", F.round("lexical", 5).alias("lexical"))


@query(
    "embed_norm",
    """SELECT vec_id, i, round(x / length, 5) AS x
       FROM (SELECT vec_id, unnest(embedding::DOUBLE[]) AS x, (generate_subscripts(embedding, 1) - 1)::INTEGER AS i,
                    sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS length FROM embeddings)""",
)
def embed_norm(t: Tables):
    unit = t.read("embeddings").select("vec_id", F.posexplode(normalised(F.col("embedding"))).alias("i", "x"))
    return unit.withColumn("x", F.round("x", 5))


@query(
    "cosine_dense",
    """SELECT e.vec_id, e.label, round(list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[])
         / sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))
         / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])), 5) AS cosine
       FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q""",
)
def cosine_dense(t: Tables):
    """Every vector against the one with vec_id 0, which stands for the encoded query."""
    vectors = t.read("embeddings")
    asked = vectors.where("vec_id = 0").first()["embedding"]
    return vectors.select("vec_id", "label", F.round(cosine_to(asked), 5).alias("cosine"))


@query(
    "topk_dense",
    "WITH " + TERMS + """,
vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v, count(*) OVER () AS n FROM embeddings),
dense AS (
  SELECT l.doc_id, l.section_idx, lexical,
         list_dot_product(e.v, q.v) / sqrt(list_dot_product(e.v, e.v)) / sqrt(list_dot_product(q.v, q.v)) AS cosine
  FROM lexical l JOIN vectors e ON e.vec_id = (l.doc_id * 7 + l.section_idx) % e.n
  JOIN vectors q ON q.vec_id = try_cast(substr(l.collection, 4) AS BIGINT)
),
ranked AS (
  SELECT doc_id, section_idx, round(0.6::DOUBLE * cosine + 0.4::DOUBLE * lexical, 5) AS score,
         row_number() OVER (PARTITION BY doc_id ORDER BY round(0.6::DOUBLE * cosine + 0.4::DOUBLE * lexical, 9) DESC, section_idx)::INTEGER
         AS importance_rank
  FROM dense
)
SELECT doc_id, section_idx, score, importance_rank FROM ranked WHERE importance_rank <= 5""",
)
def topk_dense(t: Tables):
    """Top sections by dense cosine and lexical score; given vectors stand for those of an encoder, dealt to sections and collections by number."""
    vectors = t.read("embeddings").select("vec_id", "embedding")
    n = vectors.count()
    number = ((F.col("doc_id") * 7 + F.col("section_idx")) % n).alias("vec_id")
    sections = t.sections.select("*", number).join(vectors, "vec_id").drop("vec_id")
    asked = t.configs.select("collection", "persona", "job", F.expr("try_cast(substring(collection, 4) AS bigint)").alias("vec_id"))
    configs = asked.join(vectors.withColumnRenamed("embedding", "vector"), "vec_id")
    scored = rv.section_scores(sections, flow.queries_of(configs), ["collection"])
    return rv.top_sections(scored).select("doc_id", "section_idx", F.round("score", 5).alias("score"), "importance_rank")


def trained_encoder(t: Tables) -> Encoder:
    return Encoder.fit(t.sections)


@query("encode_sections")
def encode_sections(t: Tables):
    """Every section as a vector of unit length by an encoder trained on all of them; tests hold it against a plain SVD."""
    return encode(t.sections, trained_encoder(t).make()).select("doc_id", "section_idx", "embedding")


@query("topk_encoded")
def topk_encoded(t: Tables):
    """Top sections by the trained encoder's cosine to the query and the lexical score."""
    sections, configs = flow.encoded(t.sections, t.configs, trained_encoder(t), ROUTES)
    scored = rv.section_scores(sections, flow.queries_of(configs, ROUTES), ["collection"])
    return rv.top_sections(scored).select("doc_id", "section_idx", F.round("score", 5).alias("score"), "importance_rank")


def scores(t: Tables):
    return rv.section_scores(t.sections, flow.queries_of(t.configs, ROUTES), ["collection"])


@query("cosine_terms", "WITH " + SCORES + " SELECT doc_id, section_idx, round(cosine, 5) AS cosine FROM scored")
def cosine_terms(t: Tables):
    return scores(t).select("doc_id", "section_idx", F.round("cosine", 5).alias("cosine"))


@query("hybrid_score", "WITH " + SCORES + " SELECT doc_id, section_idx, round(score, 5) AS score FROM scored")
def hybrid_score(t: Tables):
    return scores(t).select("doc_id", "section_idx", F.round("score", 5).alias("score"))


@query("rank_sections", "WITH " + SCORES + " SELECT doc_id, section_idx, importance_rank FROM ranked")
def rank_sections(t: Tables):
    scored = scores(t).select("doc_id", "section_idx", "score")
    return ranking.rank_sections(scored).select("doc_id", "section_idx", "importance_rank")


@query(
    "topk_sections",
    "WITH " + SCORES
    + " SELECT collection, doc_id, section_idx, round(score, 5) AS score, importance_rank FROM ranked WHERE importance_rank <= 5",
)
def topk_sections(t: Tables):
    return rv.top_sections(scores(t)).select(
        "collection", "doc_id", "section_idx", F.round("score", 5).alias("score"), "importance_rank"
    )


@query(
    "topk_collection",
    "WITH " + SCORES
    + """ SELECT collection, doc_id, section_idx, round(score, 5) AS score, importance_rank
          FROM (SELECT * REPLACE (row_number() OVER (PARTITION BY collection ORDER BY round(score, 9) DESC, doc_id, section_idx)::INTEGER
                                  AS importance_rank) FROM ranked) WHERE importance_rank <= 5""",
)
def topk_collection(t: Tables):
    return rv.top_of_collection(scores(t), "collection").select(
        "collection", "doc_id", "section_idx", F.round("score", 5).alias("score"), "importance_rank"
    )


REFINED = (
    SCORES
    + rf""",
top AS (SELECT * FROM ranked WHERE importance_rank <= 5),
sentences AS (
  SELECT doc_id, section_idx, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS nr
  FROM (SELECT doc_id, section_idx,
               list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda s: {sql_strip('s')}), lambda s: s <> '') AS ss
        FROM top)
),
sentence_words AS (
  SELECT doc_id, section_idx, nr, unnest(regexp_extract_all(lower(sentence), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM sentences
),
sentence_tf AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, section_idx, term) AS tf FROM sentence_words
),
sentence_scores AS (
  SELECT doc_id, section_idx, nr, sum(tf * (ln((1 + n)::DOUBLE / (1 + df)::DOUBLE) + 1)) / count(*) AS mean_weight
  FROM sentence_tf JOIN df USING (doc_id, term) JOIN size USING (doc_id) GROUP BY ALL
),
placed AS (
  SELECT s.*, row_number() OVER (PARTITION BY doc_id, section_idx
                                 ORDER BY round(coalesce(mean_weight, 0), 9) DESC, nr) AS place
  FROM sentences s LEFT JOIN sentence_scores USING (doc_id, section_idx, nr)
),
refined AS (
  SELECT doc_id, section_idx, string_agg(sentence, ' ' ORDER BY nr) AS refined_text
  FROM placed WHERE place <= 3 GROUP BY ALL
),
chosen AS (SELECT top.*, coalesce(refined_text, '') AS refined_text FROM top LEFT JOIN refined USING (doc_id, section_idx))"""
)


@query("refine_text", "WITH " + REFINED + " SELECT doc_id, section_idx, importance_rank, refined_text FROM chosen")
def refine_text(t: Tables):
    return flow.best_sections(t.sections, t.configs, routes=ROUTES).select("doc_id", "section_idx", "importance_rank", "refined_text")


# --- Font levels and slices -----------------------------------------------------------------------


def _levels_sql(blocks: str) -> str:
    """Cut points by brute force over the sizes of each document, on top of a `blocks` relation."""
    return f"""
bins AS (SELECT doc_id, round(font_size, 2) AS points, count(*) AS n FROM {blocks} GROUP BY ALL),
prefix AS (
  SELECT doc_id, points, row_number() OVER w AS i, count(*) OVER (PARTITION BY doc_id) AS size,
         sum(n) OVER w AS c, sum(n * points) OVER w AS s, sum(n * points * points) OVER w AS q
  FROM bins WINDOW w AS (PARTITION BY doc_id ORDER BY points)
),
cuts AS (
  SELECT a.doc_id, a.i AS first, b.i AS second,
         round((a.q - a.s * a.s / a.c) + (b.q - a.q - (b.s - a.s) * (b.s - a.s) / (b.c - a.c))
               + (z.q - b.q - (z.s - b.s) * (z.s - b.s) / (z.c - b.c)), 6) AS cost
  FROM prefix a JOIN prefix b ON a.doc_id = b.doc_id AND a.i < b.i
  JOIN prefix z ON z.doc_id = a.doc_id AND z.i = z.size AND b.i < z.i
  WHERE a.size > 3
),
best AS (SELECT doc_id, arg_min(first, (cost, first, second)) AS first, arg_min(second, (cost, first, second)) AS second
         FROM cuts GROUP BY doc_id),
borders AS (
  SELECT p.doc_id, max(CASE WHEN p.i = b.second + 1 THEN p.points END) AS h1_from,
         max(CASE WHEN p.i = b.first + 1 THEN p.points END) AS h2_from
  FROM prefix p JOIN best b USING (doc_id) GROUP BY p.doc_id
  UNION ALL
  SELECT doc_id, max(CASE WHEN i = size THEN points END), max(CASE WHEN i = greatest(size - 1, 1) THEN points END)
  FROM prefix WHERE size <= 3 GROUP BY doc_id
),
levelled AS (
  SELECT b.*, CASE WHEN round(font_size, 2) >= h1_from THEN 'H1' WHEN round(font_size, 2) >= h2_from THEN 'H2' ELSE 'H3' END AS level
  FROM {blocks} b JOIN borders USING (doc_id)
)"""


BLOCK_SIZES = (
    SPANS
    + rf""",
blocks AS (
  SELECT doc_id, page + 1 AS page, block_idx, sum(size * length(text)) / sum(length(text)) AS font_size
  FROM spans GROUP BY doc_id, page, block_idx HAVING {sql_strip("string_agg(text, '')")} <> ''
),"""
)


@query("font_levels", "WITH " + BLOCK_SIZES + _levels_sql("blocks") + " SELECT doc_id, block_idx, page, level FROM levelled")
def font_levels(t: Tables):
    return sc.with_levels(ln.blocks_from_spans(t.spans)).select("doc_id", "block_idx", "page", "level")


@query(
    "section_slices",
    "WITH "
    + LINES
    + ", text_blocks AS (SELECT doc_id, line_idx AS block_idx, text, font_size, page FROM lines),"
    + _levels_sql("text_blocks")
    + rf""",
marked AS (
  SELECT *, sum(CASE WHEN level IN ('H1', 'H2') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block_idx) AS section
  FROM levelled
),
sliced AS (
  SELECT doc_id, (section - 1)::INTEGER AS section_idx, arg_min(page, block_idx) AS page, arg_min(level, block_idx) AS level,
         {sql_strip("regexp_replace(arg_min(text, block_idx), '[ ]+', ' ', 'g')")} AS t,
         min(block_idx) AS start_idx, max(block_idx) AS end_idx, string_agg(text, ' ' ORDER BY block_idx) AS text
  FROM marked WHERE section > 0 GROUP BY doc_id, section
)
SELECT doc_id, section_idx, page, level, start_idx, end_idx, text,
       CASE WHEN length(t) <= 100 THEN t WHEN instr(t, '.') BETWEEN 2 AND 100 THEN substr(t, 1, instr(t, '.'))
            ELSE rtrim(substr(t, 1, 100)) || '...' END AS title
FROM sliced""",
)
def section_slices(t: Tables):
    return sc.slice_sections(sc.with_levels(t.blocks), F.col("level").isin("H1", "H2"))
