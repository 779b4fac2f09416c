"""Rankers: BM25, TF-IDF dot product and cosine, term-match counts, top-k."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusq.functions.weights import bm25_saturation, half_even, idf_bm25, idf_smoothed, ratio
from corpusq.operators import postings as P
from corpusq.operators.index import ANCHOR, Index
from corpusq.operators.joins import fits_broadcast, sized_join
from corpusq.operators.match import QueryTerms, known_terms, matches, postings_of_terms, terms_for, with_lengths
from corpusq.sources.storage import materialize

BM25_PLACES = 4
TFIDF_PLACES = 5

# Indexes of so many documents prune by block bounds; below, the extra jobs cost more than they save.
PRUNE_DOCS = 1_000_000

# Slices in which the results of a query are ranked first, for limits above Spark's own.
SLICES = 32


class Bm25(NamedTuple):
    """BM25 parameters: saturation and length normalisation."""

    k1: float = 1.5
    b: float = 0.75


def top_k(scored: DataFrame, k: int, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The ``k`` best rows per group with their rank; ties by document id.

    Spark lets every task cut its share to ``k`` rows per group before the
    shuffle, up to a limit on ``k``. Above it the groups are first cut in slices,
    so that no task ever sorts all the candidates of a group.
    """
    limit = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        slices = scored.withColumn("_slice", F.pmod(F.hash("doc_id"), F.lit(SLICES)))
        scored = _ranked(slices, k, (*by, "_slice")).drop("rank", "_slice")
    return _ranked(scored, k, by)


def _ranked(scored: DataFrame, k: int, by: tuple[str, ...]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_all(scored: DataFrame) -> DataFrame:
    """All rows with their rank per query, in order; ties by document id.

    Rows are range-partitioned and written, each stretch of a query is numbered on its
    own, and the rows of a query in earlier partitions give the offsets. So no
    task gets all the rows of a query.
    """
    order = ["query_id", F.desc("score"), "doc_id"]
    parts = scored.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = materialize(parts, "ranked")
    before = Window.partitionBy("query_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("query_id", "_part").agg(F.count("*").alias("_rows"))
    offsets = counts.select("query_id", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("query_id", "_part").orderBy(F.desc("score"), "doc_id"))
    numbered = parts.withColumn("_within", within).join(offsets, ["query_id", "_part"])
    ranked = numbered.withColumn("rank", (F.col("_within") + F.col("_before")).cast("int"))
    return ranked.drop("_within", "_before", "_part").orderBy("query_id", "rank")


def bm25_scores(
    index: Index,
    queries: DataFrame | QueryTerms,
    field: str = "body",
    params: Bm25 = Bm25(),
    *,
    stop: P.StopWords | None = None,
    doc_len: DataFrame | None = None,
    postings: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score)`` of every candidate, rounded to 4 places.

    Lengths are those stored with the postings; ``doc_len(doc_id, dl)`` replaces
    them. A document of unknown length counts as empty. ``postings`` is another copy of the index's
    postings, as ``postings_by_document`` opens: with it and a batch that can be broadcast, matches are not shuffled.
    """
    terms = terms_for(index, queries, stop)
    n, avg_dl = index.n, index.avg_dl
    if doc_len is not None:
        n, avg_dl = doc_len.agg(F.count("*"), F.avg("dl")).first()
    weighted = known_terms(index, terms, field).select(
        "query_id", "term", "df", (F.col("qtf") * idf_bm25(float(n), F.col("df"))).alias("weight")
    )
    rows = matches(index, weighted, terms, field, postings)
    if doc_len is not None:
        rows = rows.drop("dl").join(doc_len.select("doc_id", "dl"), "doc_id", "left")
    else:
        rows = with_lengths(index, rows, field)
    length = F.coalesce("dl", F.lit(0))
    part = F.col("weight") * bm25_saturation(F.col("tf"), length, avg_dl, params.k1, params.b)
    return rows.groupBy("query_id", "doc_id").agg(half_even(F.sum(part), BM25_PLACES).alias("score"))


def bm25(
    index: Index,
    queries: DataFrame | QueryTerms,
    field: str = "body",
    params: Bm25 = Bm25(),
    n: int = 100,
    *,
    stop: P.StopWords | None = None,
    doc_len: DataFrame | None = None,
    prune: bool | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: the ``n`` best documents per query.

    ``prune`` leaves out, by the bounds of document blocks, what cannot be among them; unless told, from
    ``PRUNE_DOCS`` documents on. The rows are the same. Link texts and other lengths have no bounds.
    """
    bounded = field != ANCHOR and doc_len is None
    if bounded and (index.n >= PRUNE_DOCS if prune is None else prune):
        return pruned_bm25(index, queries, field, params, n, stop=stop)
    return top_k(bm25_scores(index, queries, field, params, stop=stop, doc_len=doc_len), n)


def pruned_bm25(
    index: Index, queries: DataFrame | QueryTerms, field: str, params: Bm25, n: int, *, stop: P.StopWords | None = None
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: as ``bm25``, without scoring every match.

    Terms that are rare in a batch of documents have no bounds stored there; their parts are added up first. The
    n-th best sum of a query is its threshold: n documents score that much at least. Each of the
    other, dense terms has bounds per block of documents, which say what it can add there at most. A
    document with rare terms stays if its sum and what its block can add reach the threshold; a block
    is open to all its documents if its dense terms alone can reach it. Only
    postings of dense terms in open blocks or of documents that stay are read on and added. All else cannot
    come within half a rounding step of the n-th best, so the ranks are those of the full scores. A
    query with fewer than n documents with rare terms has no threshold and is scored in full.
    """
    parts = bounded_parts(index, terms_for(index, queries, stop), field, params, n)
    return top_k(parts.groupBy("query_id", "doc_id").agg(half_even(F.sum("part"), BM25_PLACES).alias("score")), n)


def bounded_parts(index: Index, terms: QueryTerms, field: str, params: Bm25, n: int) -> DataFrame:
    """``(query_id, doc_id, part)`` that add up to the BM25 score of every document that can be among the ``n`` best."""
    avg_dl = index.avg_dl
    weighted = known_terms(index, terms, field).select(
        "query_id", "term", "df", (F.col("qtf") * idf_bm25(float(index.n), F.col("df"))).alias("weight")
    )
    weighted = materialize(weighted, "weighted")
    at = ["query_id", "batch", "block"]
    bounds = postings_of_terms(index, index.block_bounds, weighted.select("query_id", "term", "weight", "df"), terms, field)
    reach = F.greatest(F.col("min_dl").cast("double"), F.col("max_tf") * F.col("min_span"))
    most = F.col("weight") * bm25_saturation(F.col("max_tf"), reach, avg_dl, params.k1, params.b)
    can_add = materialize(bounds.groupBy(*at).agg(F.sum(most).alias("can_add")), "can_add")
    dense = index.of_terms(index.block_bounds.where(F.col("field") == field), terms.terms)
    dense = dense.join(F.broadcast(weighted.select("term").distinct()), "term", "left_semi") if terms.small else dense
    dense = materialize(dense.select("batch", "term").distinct(), "dense_terms")
    dense_fits = fits_broadcast(dense)
    rows = postings_of_terms(index, index.blocked_postings(), weighted, terms, field)
    part = F.col("weight") * bm25_saturation(F.col("tf"), F.coalesce("dl", F.lit(0)), avg_dl, params.k1, params.b)
    rows = rows.select(*at, "term", "doc_id", part.alias("part"))
    rare = sized_join(rows, dense, ["batch", "term"], "left_anti", spread="doc_id", small_fits=dense_fits)
    sums = materialize(rare.groupBy(*at, "doc_id").agg(F.sum("part").alias("score")), "rare_sums")
    threshold = top_k(sums, n).where(F.col("rank") == n).select("query_id", (F.col("score") - 10.0**-BM25_PLACES).alias("threshold"))
    threshold = materialize(threshold, "thresholds")
    reached = F.col("threshold").isNull() | (F.coalesce("score", F.lit(0.0)) + F.coalesce("can_add", F.lit(0.0)) >= F.col("threshold"))
    # A row per query at most.
    by_query = F.broadcast(threshold) if terms.small else threshold
    alive = materialize(sums.join(can_add, at, "left").join(by_query, "query_id", "left").where(reached).select(*at, "doc_id", "score"), "alive")
    alone = can_add.withColumn("score", F.lit(0.0)).join(by_query, "query_id", "left").where(reached)
    both = alive.select(*at, F.lit(False).alias("open")).unionByName(alone.select(*at, F.lit(True).alias("open")))
    blocks = materialize(both.groupBy(*at).agg(F.max("open").alias("open")), "blocks")
    common = sized_join(rows, dense, ["batch", "term"], "left_semi", spread="doc_id", small_fits=dense_fits)
    common = sized_join(common, blocks, at, spread="doc_id")
    living = alive.select("query_id", "doc_id", F.lit(True).alias("living"))
    common = sized_join(common, living, ["query_id", "doc_id"], "left", spread="block").where("open or living")
    return alive.select("query_id", "doc_id", F.col("score").alias("part")).unionByName(common.select("query_id", "doc_id", "part"))


def bm25_fields(
    index: Index, queries: DataFrame, profiles: Mapping[str, Bm25], n: int = 100, stop: P.StopWords | None = None
) -> DataFrame:
    """BM25 over several fields, each with its own parameters and its own top ``n``.

    ``(field, query_id, doc_id, score, rank)``. The queries are tokenised and
    measured once.
    """
    terms = terms_for(index, queries, stop)
    parts = [
        bm25(index, terms, field, params, n).select(
            F.lit(field).alias("field"), "query_id", "doc_id", "score", "rank"
        )
        for field, params in profiles.items()
    ]
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionByName(part)
    return ranked


def query_vectors(index: Index, terms: QueryTerms, field: str) -> DataFrame:
    """``(query_id, term, weight)``: ``qtf/qlen * ln(n/df + 1e-9)`` of known terms."""
    weight = F.col("qtf") / F.col("qlen") * idf_smoothed(float(index.n), F.col("df"))
    return known_terms(index, terms, field).select("query_id", "term", weight.alias("weight"))


def tfidf_candidates(
    index: Index, queries: DataFrame, field: str = "body", stop: P.StopWords | None = None
) -> DataFrame:
    """``(query_id, doc_id, term, weight)``: ``tf/dl * ln(n/df + 1e-9)`` per match."""
    terms = terms_for(index, queries, stop)
    weight = ratio(F.col("tf"), F.col("dl")) * idf_smoothed(float(index.n), F.col("df"))
    wanted = known_terms(index, terms, field).select("query_id", "term", "df")
    found = with_lengths(index, matches(index, wanted, terms, field), field)
    return found.where(F.col("dl").isNotNull()).select("query_id", "doc_id", "term", weight.alias("weight"))


def tfidf_scores(
    index: Index,
    queries: DataFrame | QueryTerms,
    field: str = "body",
    *,
    stop: P.StopWords | None = None,
    norms: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score)``: query and document vectors multiplied.

    Without ``norms`` the plain dot product; with ``norms(doc_id, weight_norm)``
    it is divided by the lengths of both vectors. Rounded to 5 places.
    """
    terms = terms_for(index, queries, stop)
    idf = idf_smoothed(float(index.n), F.col("df"))
    share = F.col("qtf") / F.col("qlen") * idf
    wanted = known_terms(index, terms, field).select(
        "query_id", "term", "df", (share * idf).alias("weight"), (share * share).alias("square")
    )
    found = with_lengths(index, matches(index, wanted, terms, field), field).where(F.col("dl").isNotNull())
    if norms is not None:
        # Dealt out by document, for the sums as well as for the norms.
        found = found.repartition("doc_id")
    dots = found.groupBy("query_id", "doc_id").agg(F.sum(F.col("weight") * ratio(F.col("tf"), F.col("dl"))).alias("dot"))
    score = F.col("dot")
    if norms is not None:
        query_norms = wanted.groupBy("query_id").agg(F.sqrt(F.sum("square")).alias("query_norm"))
        # One row per query, so small whenever the query terms are.
        dots = sized_join(dots, query_norms, ["query_id"], spread="doc_id", small_fits=terms.small)
        dots = dots.join(norms.select("doc_id", "weight_norm"), "doc_id")
        size = F.col("query_norm") * F.col("weight_norm")
        score = F.when(size > 0, F.col("dot") / size).otherwise(0.0)
    return dots.select("query_id", "doc_id", half_even(score, TFIDF_PLACES).alias("score"))


def tfidf(
    index: Index,
    queries: DataFrame | QueryTerms,
    field: str = "body",
    n: int = 100,
    *,
    stop: P.StopWords | None = None,
    norms: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score, rank)`` by TF-IDF dot product, or cosine with ``norms``."""
    return top_k(tfidf_scores(index, queries, field, stop=stop, norms=norms), n)


def term_match(
    index: Index,
    queries: DataFrame | QueryTerms,
    field: str,
    rank_by: str = "tf_sum",
    limit: int | None = 100,
    *,
    stop: P.StopWords | None = None,
) -> DataFrame:
    """Documents of a field by how often (``tf_sum``) query terms occur in it, or
    by how many different ones do (``distinct_terms``).

    ``(query_id, doc_id, score, rank)``. ``limit=None`` gives all matches in
    order of query and rank.
    """
    terms = terms_for(index, queries, stop)
    weights = {"tf_sum": F.sum(F.col("qtf") * F.col("tf")), "distinct_terms": F.count("*")}
    scored = (
        matches(index, terms.rows.select("query_id", "term", "qtf"), terms, field)
        .groupBy("query_id", "doc_id")
        .agg(weights[rank_by].alias("score"))
    )
    if limit is None:
        return rank_all(scored)
    return top_k(scored, limit)
