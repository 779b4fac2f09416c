"""Merging ranked fields, boosting with page statistics, attaching titles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.functions.weights import half_even
from corpusq.operators.joins import lookup
from corpusq.operators.rank import BM25_PLACES, top_k
from corpusq.sources.storage import materialize


def merge_fields(
    ranked: DataFrame,
    weights: Mapping[str, float],
    page_rank: DataFrame,
    page_views: DataFrame,
    *,
    rank_weight: float = 0.5,
    view_weight: float = 0.5,
    n: int = 3,
    boost=lambda c: c,
) -> DataFrame:
    """Weighted sum of field scores, PageRank and page views; top ``n`` per query.

    ``ranked(field, query_id, doc_id, score)`` holds each field's results. Adding
    up the weighted rows per document is the full outer join of the fields without
    a join. The page tables only concern documents that some field returned, so
    they are read after the merge, for those documents. ``boost`` transforms both
    page statistics before they are weighted.

    Gives ``(query_id, doc_id, score, rank)``.
    """
    weight: Column = F.lit(0.0)
    for field, share in weights.items():
        weight = F.when(F.col("field") == field, F.lit(share)).otherwise(weight)
    merged = ranked.groupBy("query_id", "doc_id").agg(F.sum(weight * F.col("score")).alias("text_score"))
    merged = materialize(merged, "merged")
    merged = lookup(merged, "doc_id", page_rank.select("doc_id", "pr"), page_views.select("doc_id", "views"))
    score = (
        F.col("text_score")
        + F.lit(rank_weight) * boost(F.coalesce("pr", F.lit(0.0)))
        + F.lit(view_weight) * boost(F.coalesce("views", F.lit(0)).cast("double"))
    )
    scored = merged.select("query_id", "doc_id", half_even(score, BM25_PLACES).alias("score"))
    return top_k(scored, n)


def attach_titles(results: DataFrame, titles: DataFrame) -> DataFrame:
    """Results with the title of each document, null where it has none."""
    return lookup(materialize(results, "results"), "doc_id", titles.select("doc_id", "title"))


def lookup_values(
    requests: DataFrame, table: DataFrame, value: str, aligned: bool = True, default=None
) -> DataFrame:
    """``(request_id, pos, doc_id, value)`` for requested documents.

    ``requests(request_id, pos, doc_id)`` lists the wanted ids. ``aligned`` keeps
    one row per wanted id, with ``default`` where the table has none; otherwise
    ids without a value, or with the value 0, are left out.
    """
    found = lookup(requests, "doc_id", table.select("doc_id", value))
    if not aligned:
        found = found.where(F.col(value) != 0)
    elif default is not None:
        found = found.withColumn(value, F.coalesce(value, F.lit(default)))
    return found.select("request_id", "pos", "doc_id", value)
