"""From lines to outlines, for all documents in one job."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame

from foliolens.operators import candidates as cd
from foliolens.operators import outline as ol
from foliolens.operators.lines import with_line_features, with_page_context, with_span_features
from foliolens.operators.training import LAYOUT_FEATURES, LINE_FEATURES, SPAN_FEATURES, TEXT_LEVELS, score
from foliolens.plans.lineage import cut


def predicted_rows(
    lines: DataFrame, model: PipelineModel | None = None, names: list[str] = LINE_FEATURES, candidates: DataFrame | None = None
) -> DataFrame:
    """Heading rows of the merged candidates, those of the lines unless given: levels from a trained model or, without one, from the font size."""
    if candidates is None:
        candidates = cd.candidates(with_line_features(lines, words=False), words=model is not None)
    if model is None:
        return ol.outline_rows(candidates.withColumn("level", ol.level_by_size()))
    return ol.outline_rows(score(candidates, model, names))


def outlines(
    documents: DataFrame, lines: DataFrame, model: PipelineModel | None = None, candidates: DataFrame | None = None
) -> DataFrame:
    """doc_id, part, title and outline of every document; `candidates` are those of the lines, where a model was trained on them.

    Heading rows are few and are read for titles, removals and numbering, so they are written out once.
    """
    titles, rest = ol.promote_title(cut(predicted_rows(lines, model, candidates=candidates)))
    return ol.outline_documents(documents, titles, rest)


def span_outlines(documents: DataFrame, spans: DataFrame, model: PipelineModel | None = None, page_base: int = 1) -> DataFrame:
    """Outlines of single spans: levels from a model of the four span features or from the size, title from the first bold large span."""
    features = with_span_features(spans)
    levelled = features.withColumn("level", ol.level_by_size()) if model is None else score(features, model, SPAN_FEATURES)
    rows = ol.outline_rows(levelled)
    return ol.outline_documents(documents, ol.span_titles(features), rows, page_base=page_base, order=ol.SPAN_ORDER)


def titled_outlines(documents: DataFrame, lines: DataFrame, model: PipelineModel | Column) -> DataFrame:
    """Outlines of lines whose levels, with Title and H4, come from a model of text and layout or from a rule; the first Title is the title."""
    features = with_page_context(with_line_features(lines, words=False))
    if isinstance(model, PipelineModel):
        levelled = score(features, model, LAYOUT_FEATURES, TEXT_LEVELS)
    else:
        levelled = features.withColumn("level", model)
    titles, rest = ol.first_title_prediction(cut(ol.outline_rows(levelled, body="NotHeading")))
    return ol.outline_documents(documents, titles, rest)
