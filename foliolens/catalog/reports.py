"""Collection reports, their validation, and the parse cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliolens.catalog.base import CONFIGS, Tables, query, sql_strip
from foliolens.catalog.relevance import REFINED, ROUTES
from foliolens.operators import report as rp
from foliolens.plans.lineage import lookup_join, scratch
from foliolens.plans.ranking_flow import collection_report_rows, collection_reports
from foliolens.sources import cache, files, sinks
from foliolens.sources.single_files import write_folders

TITLED = (
    REFINED
    + rf""",
titled AS (
  SELECT *, 'doc-' || doc_id AS document,
         CASE WHEN length(s) <= 100 THEN s WHEN instr(s, '.') BETWEEN 2 AND 100 THEN substr(s, 1, instr(s, '.'))
              ELSE rtrim(substr(s, 1, 100)) || '...' END AS section_title, page + 1 AS page_number
  FROM (SELECT *, {sql_strip("regexp_replace(text, '[ ]+', ' ', 'g')")} AS s FROM chosen)
)"""
)


# Expected contents of each collection's report.
EXPECTED = """
expected AS (
  SELECT c.collection, c.persona, c.job, documents, coalesce(sections, 0) AS sections, spanish
  FROM configs c
  JOIN (SELECT source AS collection, count(*) AS documents, count(*) FILTER (lang = 'es') AS spanish FROM documents GROUP BY ALL) d
    USING (collection)
  LEFT JOIN (SELECT collection, count(*) AS sections FROM titled GROUP BY ALL) s USING (collection)
)"""


def _named(t: Tables):
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("document")
    return t.documents.select(F.col("source").alias("collection"), "doc_id", name)


def reports(t: Tables):
    return collection_reports(_named(t), t.sections, t.configs, routes=ROUTES)


def report_lines(t: Tables):
    """One JSON file per collection, written and read back line by line."""
    folder = scratch(t.spark, "reports")
    sinks.write_report_files(collection_report_rows(_named(t), t.sections, t.configs, routes=ROUTES), folder)
    return sinks.read_report_lines(t.spark, folder)


@query(
    "report_sections",
    "WITH " + TITLED
    + " SELECT collection, document, section_title, importance_rank, page_number, refined_text FROM titled",
)
def report_sections(t: Tables):
    """The two lists of the reports, side by side again."""
    parsed = rp.parse_reports(rp.report_json(reports(t)))
    pairs = F.arrays_zip("extracted_sections", "subsection_analysis")
    rows = parsed.select("collection", F.explode(pairs).alias("p"))
    return rows.select(
        "collection",
        "p.extracted_sections.document",
        "p.extracted_sections.section_title",
        "p.extracted_sections.importance_rank",
        "p.extracted_sections.page_number",
        "p.subsection_analysis.refined_text",
    )


@query(
    "report_json",
    "WITH " + TITLED + f", {EXPECTED} SELECT collection, persona, job, documents, sections, sections AS analyses, 1 AS stamped FROM expected",
)
def report_json(t: Tables):
    """What the JSON report of each collection holds, but for the time stamp, of which only the form is looked at."""
    stamped = F.col("processing_timestamp").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+$").cast("int").alias("stamped")
    return rp.summarise_lines(report_lines(t)).select("collection", "persona", "job", "documents", "sections", "analyses", stamped)


RULES = [
    "metadata present", "sections present", "analysis present", "metadata.input_documents present",
    "metadata.persona present", "metadata.job_to_be_done present", "metadata.processing_timestamp present",
    "sections.document present", "sections.section_title present", "sections.importance_rank present",
    "sections.page_number present", "analysis.document present", "analysis.refined_text present",
    "analysis.page_number present", "sections not empty", "analysis not empty", "persona equal", "job equal",
    "document count equal",
]

# In the expectations, collections whose name ends in 7 have another persona, and each misses its Spanish documents.
VIOLATIONS = {
    "sections.section_title present": "SELECT count(*) FROM titled WHERE section_title IS NULL",
    "analysis.refined_text present": "SELECT count(*) FROM titled WHERE refined_text IS NULL",
    "sections not empty": "SELECT count(*) FROM expected WHERE sections = 0",
    "analysis not empty": "SELECT count(*) FROM expected WHERE sections = 0",
    "persona equal": "SELECT count(*) FROM expected WHERE collection LIKE '%7'",
    "document count equal": "SELECT count(*) FROM expected WHERE spanish > 0",
}


@query(
    "validate_report",
    "WITH " + TITLED + ", " + EXPECTED + " "
    + " UNION ALL ".join(f"SELECT '{r}' AS rule, ({VIOLATIONS.get(r, 'SELECT 0')})::BIGINT AS violations" for r in RULES),
)
def validate_report(t: Tables):
    counts = t.documents.groupBy(F.col("source").alias("collection")).agg(F.count_if(F.col("lang") != "es").alias("documents"))
    persona = F.when(F.col("collection").endswith("7"), F.upper("persona")).otherwise(F.col("persona"))
    truth = t.configs.join(counts, "collection").select("collection", persona.alias("persona"), "job", "documents")
    return rp.validate_lines(report_lines(t), truth)


PER_CONFIG = 100
#: Tasks that write files of collections, per core.
TASKS_PER_CORE = 4


@query(
    "src_collection",
    "WITH " + CONFIGS
    + f""" SELECT collection, collection AS persona, CASE WHEN name LIKE '%7' THEN '' ELSE job END AS job, documents
          FROM (SELECT source || '-' || doc_id // {PER_CONFIG} AS collection, source AS name, count(*)::INTEGER AS documents
                FROM documents GROUP BY ALL) JOIN (SELECT collection AS name, job FROM configs) USING (name)""",
)
def src_collection(t: Tables):
    """Configs of ranges of 100 document numbers, one file in a folder each, read back by the reader; those of collections ending in 7 lack the job.

    The folder's name is the collection, so the layout is that of `partitionBy`, which the reader expects but for the name before "=".
    """
    folder = scratch(t.spark, "collections")
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    parted = t.documents.withColumn("part", F.floor(F.col("doc_id") / PER_CONFIG).cast("string"))
    listed = parted.groupBy(F.col("source").alias("collection"), "part").agg(
        F.array_sort(F.collect_list(F.struct(name.alias("filename"), F.lit("").alias("title")))).alias("documents")
    )
    job = F.when(F.col("collection").endswith("7"), F.lit(None)).otherwise(F.struct(F.col("job").alias("task")))
    made = lookup_join(listed, t.configs, ["collection"], "inner", salt="part").select(
        F.concat_ws("-", "collection", "part").alias("folder"),
        "documents",
        F.struct(F.concat_ws("-", "collection", "part").alias("role")).alias("persona"),
        job.alias("job_to_be_done"),
    )
    # JSON over several lines, as such files are: one text row per file.
    text = F.to_json(F.struct("documents", "persona", "job_to_be_done"), {"pretty": "true"})
    # Many small files: spread over all cores, and written by the tasks themselves.
    tasks = TASKS_PER_CORE * t.spark.sparkContext.defaultParallelism
    values = made.select("folder", text.alias("value")).repartition(tasks, "folder")
    write_folders(values, folder, F.concat(F.lit("folder="), F.col("folder")), F.col("value"))
    back = files.read_collections(t.spark, folder, "part-*")
    return back.withColumns({
        "collection": F.regexp_replace("collection", "^folder=", ""), "documents": F.size("documents"),
    })


@query(
    "cache_new_docs",
    """SELECT doc_id, md5('docs/' || doc_id || '.pdf') AS cache_key FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def cache_new_docs(t: Tables):
    """Documents with labels count as parsed before: their keys form the cache table."""
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    parsed = t.read("labels").select(cache.cache_key(path).alias("cache_key"))
    return cache.new_documents(t.documents.select("doc_id"), parsed, cache.cache_key(path)).select("doc_id", "cache_key")
