"""Full ranking of the sections of a document, for documents of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliolens.operators.relevance import SCORE_DIGITS
from foliolens.plans.chunks import carry, chunk_of
from foliolens.plans.lineage import cut

STEPS_PER_POINT = 1000


def rank_sections(scored: DataFrame) -> DataFrame:
    """Rank 1..n of every section in its document by descending score, in section order on ties.

    The rank is the number of sections in higher score steps, plus those with higher scores in the same step,
    plus those of equal score in earlier chunks, plus the place in the own chunk.  Each part comes from
    counts, so a task sees one chunk of equal scores or the counts of one step.  Scores are written out first,
    as all parts must see the same bits.
    """
    fixed = cut(scored.withColumn("_rounded", F.round("score", SCORE_DIGITS)))
    rows = (
        fixed.withColumn("_step", -F.floor(F.col("_rounded") * STEPS_PER_POINT))
        .withColumn("_below", -F.col("_rounded"))
        .withColumn("_chunk", F.struct("_below", chunk_of("section_idx").alias("at")))
    )
    steps = (
        rows.groupBy("doc_id", "_step")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "doc_id",
            "_step",
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy("doc_id").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_above"),
        )
    )

    def combine(part, w):
        inside = F.coalesce(F.sum("_n").over(w.before), F.lit(0)).alias("_inside")
        counted = part.select("doc_id", "_step", "_chunk", inside)
        return counted.join(steps, ["doc_id", "_step"], "inner")

    joined = carry(rows, ["doc_id", "_step"], "_chunk", [F.count(F.lit(1)).alias("_n")], combine)
    place = F.row_number().over(Window.partitionBy("doc_id", "_step", "_chunk").orderBy("section_idx"))
    rank = (F.col("_above") + F.col("_inside") + place).cast("int")
    return joined.withColumn("importance_rank", rank).drop(
        "_rounded", "_step", "_below", "_chunk", "_above", "_inside"
    )
