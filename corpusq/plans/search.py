"""The searches a user runs: combined, body, title, anchor; and scored batches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from corpusq.operators import postings as P
from corpusq.operators.evaluate import evaluate
from corpusq.operators.fuse import attach_titles, merge_fields
from corpusq.operators.index import Index
from corpusq.operators.rank import Bm25, bm25_fields, term_match, tfidf


@dataclass(frozen=True)
class SearchParams:
    """Settings of the combined search. The reference defaults."""

    profiles: dict[str, Bm25] = field(
        default_factory=lambda: {"title": Bm25(k1=2.0, b=0.05), "body": Bm25(k1=5.0, b=0.2)}
    )
    weights: dict[str, float] = field(default_factory=lambda: {"title": 0.3, "body": 0.7})
    rank_weight: float = 0.15
    view_weight: float = 0.15
    per_field: int = 100
    n: int = 40


def search(
    index: Index,
    queries: DataFrame,
    page_rank: DataFrame,
    page_views: DataFrame,
    titles: DataFrame,
    params: SearchParams = SearchParams(),
    stop: P.StopWords | None = None,
) -> DataFrame:
    """BM25 on title and body, merged and boosted: ``(query_id, doc_id, score, rank, title)``."""
    ranked = bm25_fields(index, queries, params.profiles, params.per_field, stop)
    merged = merge_fields(
        ranked,
        params.weights,
        page_rank,
        page_views,
        rank_weight=params.rank_weight,
        view_weight=params.view_weight,
        n=params.n,
    )
    return attach_titles(merged, titles)


def search_body(
    index: Index,
    queries: DataFrame,
    titles: DataFrame,
    n: int = 100,
    *,
    norms: DataFrame | None = None,
    stop: P.StopWords | None = None,
) -> DataFrame:
    """TF-IDF over the body, by dot product, or by cosine when given ``norms``."""
    return attach_titles(tfidf(index, queries, "body", n, stop=stop, norms=norms), titles)


def search_title(
    index: Index,
    queries: DataFrame,
    titles: DataFrame,
    rank_by: str = "tf_sum",
    limit: int | None = 100,
    stop: P.StopWords | None = None,
) -> DataFrame:
    """Documents with query words in their title."""
    return attach_titles(term_match(index, queries, "title", rank_by, limit, stop=stop), titles)


def search_anchor(
    index: Index,
    queries: DataFrame,
    titles: DataFrame,
    rank_by: str = "tf_sum",
    limit: int | None = 100,
    stop: P.StopWords | None = None,
) -> DataFrame:
    """Documents with query words in the texts of links to them."""
    return attach_titles(term_match(index, queries, "anchor", rank_by, limit, stop=stop), titles)


def batch_evaluation(results: DataFrame, qrels: DataFrame, queries: DataFrame, k: int = 40) -> DataFrame:
    """``(query_id, text, avg_precision)`` of every judged query of a batch."""
    per_query = evaluate(results, qrels, k).select("query_id", "avg_precision")
    return queries.join(per_query, "query_id").select("query_id", "text", "avg_precision")
