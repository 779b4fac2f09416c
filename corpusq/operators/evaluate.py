"""Retrieval quality against relevance judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.functions.weights import round_exact

PLACES = 3
F_SCORE_CUTOFF = 100
FLAT_CUTOFF = 40

METRICS = (
    "recall_at_k",
    "precision_at_k",
    "f_score",
    "r_precision",
    "avg_precision",
    "avg_precision_flat",
)


def relevant_hits(results: DataFrame, qrels: DataFrame) -> DataFrame:
    """``(query_id, doc_id, rank)``: results that are judged relevant."""
    judged = qrels.select("query_id", "doc_id").distinct()
    return results.select("query_id", "doc_id", "rank").join(judged, ["query_id", "doc_id"])


def evaluate(
    results: DataFrame,
    qrels: DataFrame,
    k: int = 40,
    f_cutoff: int = F_SCORE_CUTOFF,
    flat_cutoff: int = FLAT_CUTOFF,
) -> DataFrame:
    """One row of metrics per judged query.

    ``results(query_id, doc_id, rank)``, ``qrels(query_id, doc_id)``. A judged
    query without results scores 0; a query without judgments is left out.
    Average precision divides by the hits found. Its flat variant is the precision
    at ``flat_cutoff``, whatever ``k``, and 0 for a query without a hit up to ``k``.
    """
    sizes = qrels.select("query_id", "doc_id").distinct().groupBy("query_id").agg(F.count("*").alias("relevant"))
    hits = (
        relevant_hits(results, qrels)
        .join(sizes, "query_id")
        .groupBy("query_id")
        .agg(
            F.count_if(F.col("rank") <= k).alias("hits_k"),
            F.count_if(F.col("rank") <= f_cutoff).alias("hits_f"),
            F.count_if(F.col("rank") <= flat_cutoff).alias("hits_flat"),
            F.count_if(F.col("rank") <= F.col("relevant")).alias("hits_r"),
            # At most k ranks per query.
            F.sort_array(F.collect_list(F.when(F.col("rank") <= k, F.col("rank")))).alias("hit_ranks"),
        )
    )
    precisions = F.transform("hit_ranks", lambda rank, i: (i + 1) / rank)
    mean_precision = F.when(
        F.size("hit_ranks") > 0, F.aggregate(precisions, F.lit(0.0), lambda a, p: a + p) / F.size("hit_ranks")
    )
    hits = hits.select("*", mean_precision.alias("mean_precision")).drop("hit_ranks")
    counts = sizes.join(hits, "query_id", "left").fillna(0)
    recall_f = round_exact(F.col("hits_f") / F.col("relevant"), PLACES)
    precision_f = round_exact(F.col("hits_f") / F.lit(f_cutoff), PLACES)
    precision_k = round_exact(F.col("hits_k") / F.lit(k), PLACES)
    precision_flat = round_exact(F.col("hits_flat") / F.lit(flat_cutoff), PLACES)
    both = recall_f + precision_f
    return counts.select(
        "query_id",
        round_exact(F.col("hits_k") / F.col("relevant"), PLACES).alias("recall_at_k"),
        precision_k.alias("precision_at_k"),
        F.when(both == 0, 0.0).otherwise(2 * recall_f * precision_f / both).alias("f_score"),
        round_exact(F.col("hits_r") / F.col("relevant"), PLACES).alias("r_precision"),
        round_exact(F.col("mean_precision"), PLACES).alias("avg_precision"),
        F.when(F.col("hits_k") > 0, precision_flat).otherwise(0.0).alias("avg_precision_flat"),
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """The mean of every metric over the queries, in one row."""
    return per_query.agg(*[F.avg(m).alias(m) for m in METRICS])
