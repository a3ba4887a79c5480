"""Collection reports: assembly and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.plans.lineage import cut, lookup_join
from foliolens.sources.schemas import REPORT_SCHEMA

DOCUMENTS_PER_PART = 5_000


def part_of(doc_id: str | Column, per_part: int = DOCUMENTS_PER_PART) -> Column:
    """Part of a document with a number: a range of doc_id, so it depends on nothing but the document."""
    return F.floor(F.col(doc_id) / per_part if isinstance(doc_id, str) else doc_id / per_part).cast("int")


def assemble(
    configs: DataFrame, documents: DataFrame, sections: DataFrame, per_part: int = DOCUMENTS_PER_PART
) -> DataFrame:
    """One report per collection: metadata, ranked sections, and the refined texts of those that have one.

    `configs` is (collection, persona, job); `documents` is (collection, doc_id, document); `sections` is
    (collection, doc_id, title, importance_rank, page, refined_text).  The report of a collection comes in parts, each
    over a range of `per_part` document numbers and a report of its own, at any size; documents without numbers
    bring a `part` column, of which no value should have many more documents.
    """
    part = F.col("part").cast("int") if "part" in documents.columns else part_of("doc_id", per_part).alias("part")
    parted = documents.select("collection", "doc_id", "document", part)
    listed = parted.join(sections.drop("collection"), "doc_id", "left")
    found = F.col("importance_rank").isNotNull()
    entry = F.struct("doc_id", "importance_rank", "document", "title", "page", "refined_text")
    per_part_lists = listed.groupBy("collection", "part").agg(
        F.array_sort(F.collect_set(F.struct("doc_id", "document"))).alias("_documents"),
        F.array_sort(F.collect_list(F.when(found, entry))).alias("_sections"),
    )
    sections_column = F.transform(
        "_sections",
        lambda s: F.struct(
            s["document"].alias("document"),
            s["title"].alias("section_title"),
            s["importance_rank"].alias("importance_rank"),
            s["page"].alias("page_number"),
        ),
    )
    analysis = F.transform(
        F.filter("_sections", lambda s: s["refined_text"].isNotNull()),
        lambda s: F.struct(
            s["document"].alias("document"),
            s["refined_text"].alias("refined_text"),
            s["page"].alias("page_number"),
        ),
    )
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    joined = lookup_join(per_part_lists, configs, ["collection"], "left", salt="part")
    return joined.select(
        "collection",
        "part",
        F.struct(
            F.transform("_documents", lambda d: d["document"]).alias("input_documents"),
            F.coalesce("persona", F.lit("")).alias("persona"),
            F.coalesce("job", F.lit("")).alias("job_to_be_done"),
            stamp.alias("processing_timestamp"),
        ).alias("metadata"),
        sections_column.alias("extracted_sections"),
        analysis.alias("subsection_analysis"),
    )


def report_json(reports: DataFrame) -> DataFrame:
    body = F.struct("metadata", "extracted_sections", "subsection_analysis")
    return reports.select("collection", "part", F.to_json(body).alias("json"))


def parse_reports(reports: DataFrame) -> DataFrame:
    """Reports read back from JSON text with the fixed schema."""
    return reports.select("collection", "part", F.from_json("json", REPORT_SCHEMA).alias("r")).select(
        "collection", "part", "r.*"
    )


#: Kinds of the rows of a report, in their order in the file.
OPENING, DOCUMENT, METADATA, SECTION, BETWEEN, ANALYSIS, CLOSING = range(7)
#: The entry without a comma comes first among equals.
LINE_ORDER = ["kind", "doc_id", "importance_rank", "later", "text"]


def _text(value: Column) -> Column:
    """A string as JSON."""
    return F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")


def report_rows(configs: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """One report per collection as the lines of its JSON text: collection, the columns of `LINE_ORDER`, line.

    Lines sorted by `LINE_ORDER` make one valid document, however long; no row holds more than one entry.  Takes the tables of `assemble`;
    documents count once per doc_id and name, repeated sections each, sections without a document not at all; collections without a
    config have an empty persona and job.  Entries keep null fields.
    """
    names = documents.select("collection", "doc_id", "document").distinct()
    sections = cut(sections.withColumn("_row", F.monotonically_increasing_id()))  # tells repeated sections apart
    listed = names.join(sections.drop("collection"), "doc_id")
    persona = lookup_join(names.select("collection").distinct(), configs.select("collection", "persona", "job"), ["collection"], "left")
    keep = {"ignoreNullFields": "false"}
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    metadata = F.struct(
        F.coalesce("persona", F.lit("")).alias("persona"), F.coalesce("job", F.lit("")).alias("job_to_be_done"), stamp.alias("processing_timestamp")
    )
    no_place = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("importance_rank")]

    def entry(kind: int, line: Column) -> list[Column]:
        return [F.lit(kind).alias("kind"), line.alias("line")]

    frame = {
        OPENING: F.lit('{"metadata":{"input_documents":['),
        METADATA: F.concat(F.lit("],"), F.substr(F.to_json(metadata), F.lit(2)), F.lit(',"extracted_sections":[')),
        BETWEEN: F.lit('],"subsection_analysis":['),
        CLOSING: F.lit("]}"),
    }
    framed = persona.select("collection", F.explode(F.array(*(F.struct(*entry(k, v)) for k, v in frame.items()))).alias("f"))
    framed = framed.select("collection", "f.kind", *no_place, "f.line")
    section = F.struct("document", F.col("title").alias("section_title"), "importance_rank", F.col("page").alias("page_number"))
    analysis = F.struct("document", "refined_text", F.col("page").alias("page_number"))
    entries = F.array(
        F.struct(*entry(SECTION, F.to_json(section, keep))),
        F.when(F.col("refined_text").isNotNull(), F.struct(*entry(ANALYSIS, F.to_json(analysis, keep)))),
    )
    no_row = F.lit(None).cast("long").alias("_row")
    listed_names = names.select("collection", F.lit(DOCUMENT).alias("kind"), "doc_id", no_place[1], no_row, _text(F.coalesce("document", F.lit(""))).alias("line"))
    found = listed.select("collection", "doc_id", "importance_rank", "_row", F.explode(F.array_compact(entries)).alias("e"))
    items = listed_names.unionByName(found.select("collection", "e.kind", "doc_id", "importance_rank", "_row", "e.line"))
    # All entries of a list but its first one follow a comma; the firsts are three rows per collection.
    order = F.struct("doc_id", "importance_rank", "line", "_row")
    firsts = items.groupBy("collection", "kind").agg(F.min(order).alias("_first"))
    marked = lookup_join(items, firsts, ["collection", "kind"], "inner", salt="doc_id")
    later = ~order.eqNullSafe(F.col("_first"))
    line = F.when(later, F.concat(F.lit(","), "line")).otherwise(F.col("line"))
    lines = marked.select("collection", "kind", "doc_id", "importance_rank", later.alias("later"), F.col("line").alias("text"), line.alias("line"))
    return framed.select("collection", "kind", "doc_id", "importance_rank", F.lit(False).alias("later"), F.lit("").alias("text"), "line").unionByName(lines)


def parse_lines(lines: DataFrame) -> DataFrame:
    """The entries of reports read line by line: collection, kind and the fields of all entries; frames but the metadata's are left out."""
    plain = F.regexp_replace("line", "^,", "")
    metadata = F.concat(F.lit("{"), F.regexp_replace(F.substr(plain, F.lit(3)), r',"extracted_sections":\[$', ""))
    body = F.when(plain.startswith('],"persona"'), metadata).otherwise(plain)
    # Keys never occur inside strings, where quotes are escaped.
    kind = (
        F.when(plain.startswith('],"persona"'), METADATA).when(plain.startswith('"'), DOCUMENT)
        .when(F.contains(plain, F.lit('"section_title":')), SECTION).when(F.contains(plain, F.lit('"refined_text":')), ANALYSIS)
    )
    fields = (
        "persona string, job_to_be_done string, processing_timestamp string, "
        "document string, section_title string, importance_rank int, page_number int, refined_text string"
    )
    parsed = lines.select("collection", kind.alias("kind"), F.from_json(body, fields).alias("r")).where("kind is not null")
    return parsed.select("collection", "kind", "r.*")


def summarise_lines(lines: DataFrame) -> DataFrame:
    """One row per collection: persona, job, processing_timestamp, documents, sections and analyses, from the lines of its report."""
    rows = parse_lines(lines)
    of = lambda kind: F.col("kind") == kind
    return rows.groupBy("collection").agg(
        *(F.max(F.when(of(METADATA), F.col(c))).alias(n) for c, n in (("persona", "persona"), ("job_to_be_done", "job"), ("processing_timestamp", "processing_timestamp"))),
        *(F.count_if(of(k)).alias(n) for k, n in ((DOCUMENT, "documents"), (SECTION, "sections"), (ANALYSIS, "analyses"))),
        *(F.count_if(of(SECTION) & F.col(f).isNull()).alias(f"_sections_{f}") for f in SECTION_FIELDS),
        *(F.count_if(of(ANALYSIS) & F.col(f).isNull()).alias(f"_analysis_{f}") for f in ANALYSIS_FIELDS),
    )


def _missing(items: str, field: str) -> Column:
    return F.size(F.filter(F.coalesce(items, F.array()), lambda i: i[field].isNull()))


METADATA_FIELDS = ["input_documents", "persona", "job_to_be_done", "processing_timestamp"]
SECTION_FIELDS = ["document", "section_title", "importance_rank", "page_number"]
ANALYSIS_FIELDS = ["document", "refined_text", "page_number"]


def validate(reports: DataFrame, truth: DataFrame) -> DataFrame:
    """Rule and number of violations over all reports, one row per rule.

    `truth` is (collection, part, persona, job, documents): the expected persona, job and document count.
    """
    failing: dict[str, Column] = {
        "metadata present": F.col("metadata").isNull().cast("int"),
        "sections present": F.col("extracted_sections").isNull().cast("int"),
        "analysis present": F.col("subsection_analysis").isNull().cast("int"),
    }
    for field in METADATA_FIELDS:
        failing[f"metadata.{field} present"] = F.col(f"metadata.{field}").isNull().cast("int")
    for field in SECTION_FIELDS:
        failing[f"sections.{field} present"] = _missing("extracted_sections", field)
    for field in ANALYSIS_FIELDS:
        failing[f"analysis.{field} present"] = _missing("subsection_analysis", field)
    failing |= {
        "sections not empty": (F.coalesce(F.size("extracted_sections"), F.lit(0)) <= 0).cast("int"),
        "analysis not empty": (F.coalesce(F.size("subsection_analysis"), F.lit(0)) <= 0).cast("int"),
    }
    # Each report is reduced to its counts and three values before it meets what is expected.
    reduced = reports.select(
        "collection", "part", *[count.alias(rule) for rule, count in failing.items()],
        F.col("metadata.persona").alias("_persona"), F.col("metadata.job_to_be_done").alias("_job"),
        F.size("metadata.input_documents").alias("_documents"),
    )
    return _judged(reduced, list(failing), truth, ["collection", "part"])


def validate_lines(lines: DataFrame, truth: DataFrame) -> DataFrame:
    """The rules of `validate` over reports read line by line (collection, line), whatever their length; `truth` has no parts."""
    found = summarise_lines(lines)
    none = lambda c: F.col(c).isNull().cast("int")
    failing: dict[str, Column] = {"metadata present": (F.col("persona").isNull() & F.col("job").isNull()).cast("int")}
    failing |= {"sections present": F.lit(0), "analysis present": F.lit(0), "metadata.input_documents present": F.lit(0)}
    failing |= {f"metadata.{f} present": none(c) for f, c in (("persona", "persona"), ("job_to_be_done", "job"), ("processing_timestamp", "processing_timestamp"))}
    failing |= {f"sections.{f} present": F.col(f"_sections_{f}") for f in SECTION_FIELDS}
    failing |= {f"analysis.{f} present": F.col(f"_analysis_{f}") for f in ANALYSIS_FIELDS}
    failing |= {"sections not empty": (F.col("sections") == 0).cast("int"), "analysis not empty": (F.col("analyses") == 0).cast("int")}
    reduced = found.select(
        "collection", *[count.alias(rule) for rule, count in failing.items()],
        F.col("persona").alias("_persona"), F.col("job").alias("_job"), F.col("documents").cast("int").alias("_documents"),
    )
    return _judged(reduced, list(failing), truth, ["collection"])


def _judged(reduced: DataFrame, rules: list[str], truth: DataFrame, keys: list[str]) -> DataFrame:
    joined = reduced.join(truth.select(*keys, "persona", "job", "documents"), keys, "left")
    equal = {
        "persona equal": F.col("_persona").eqNullSafe(F.col("persona")),
        "job equal": F.col("_job").eqNullSafe(F.col("job")),
        "document count equal": F.col("_documents").eqNullSafe(F.col("documents").cast("int")),
    }
    sums = [F.sum(F.col(f"`{rule}`")).cast("long").alias(rule) for rule in rules]
    counts = joined.agg(*sums, *[F.count_if(~same).alias(rule) for rule, same in equal.items()])
    return counts.select(
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("violations")) for r in [*rules, *equal]])).alias("row")
    ).select("row.rule", F.coalesce("row.violations", F.lit(0)).cast("long").alias("violations"))
