"""Query terms, and their postings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.functions.text import STOP_WORDS, term_bucket
from corpusq.operators import postings as P
from corpusq.operators.index import ANCHOR, LITERAL_TERMS, Index
from corpusq.operators.joins import deal_out, fits_broadcast, sized_join
from corpusq.sources.storage import materialize


# At most this many query terms are fetched to see how many there are.
FETCH_ROWS = 20_000


@dataclass(frozen=True)
class QueryTerms:
    """A batch of tokenised queries and what is known about its size.

    ``rows`` is ``(query_id, term, qtf, qlen)``; ``terms`` lists the distinct
    terms when they are few enough to prune scans with; ``small`` tells whether
    the rows may be broadcast.
    """

    rows: DataFrame
    terms: tuple[str, ...] | None
    small: bool


def query_terms(
    queries: DataFrame, stop: P.StopWords = STOP_WORDS, lemmas: DataFrame | None = None
) -> DataFrame:
    """``(query_id, term, qtf, qlen)`` from ``queries(query_id, text)``.

    ``qlen`` counts all kept tokens, also those no document contains. A query
    without tokens has no rows. For an index over lemmas pass its ``lemmas``: forms
    become lemmas as they do in documents.
    """
    counted = P.document_terms(queries, ["text"], stop, id_col="query_id", is_scan=False)
    rows = P.postings_of(counted, ["text"], "query_id")
    if lemmas is not None:
        rows = P.lemma_postings(rows, lemmas, stop)
    return rows.select(
        F.col("doc_id").alias("query_id"), "term", F.col("tf").alias("qtf"), F.col("dl").alias("qlen")
    )


def measured_terms(
    queries: DataFrame, stop: P.StopWords = STOP_WORDS, lemmas: DataFrame | None = None
) -> QueryTerms:
    """Query terms with their size measured: one bounded fetch, a count if it overflows."""
    rows = query_terms(queries, stop, lemmas)
    head = rows.select("term").limit(FETCH_ROWS + 1).collect()
    if len(head) > FETCH_ROWS:
        return QueryTerms(rows, None, fits_broadcast(rows))
    terms = {r.term for r in head}
    return QueryTerms(rows, tuple(sorted(terms)) if len(terms) <= LITERAL_TERMS else None, True)


def terms_for(index: Index, queries: DataFrame | QueryTerms, stop: P.StopWords | None = None) -> QueryTerms:
    """The terms of queries as the index has them: without its stop words (or those given), as its lemmas."""
    if isinstance(queries, QueryTerms):
        return queries
    return measured_terms(queries, index.words.stop if stop is None else stop, index.words.lemmas)


def known_terms(index: Index, terms: QueryTerms, field: str) -> DataFrame:
    """Query terms found in a field, with their ``df``: ``(query_id, term, qtf, qlen, df)``."""
    stats = index.of_terms(index.term_stats.where(F.col("field") == field), terms.terms)
    stats = stats.select("term", "df")
    if terms.small:
        return stats.join(F.broadcast(terms.rows), "term").select("query_id", "term", "qtf", "qlen", "df")
    return sized_join(terms.rows, stats, ["term"], spread="query_id")


def matches(
    index: Index, weighted: DataFrame, terms: QueryTerms, field: str, postings: DataFrame | None = None
) -> DataFrame:
    """Postings of weighted query terms, one row per query, document and term.

    ``weighted`` has ``query_id``, ``term`` and any weights, at most one row per
    row of ``terms``. Small batches are broadcast to the scan of the postings,
    which is cut down to their terms; for large ones with a ``df`` a frequent term
    is spread over several tasks by document. Terms that ``min_df`` hides are
    taken out of the queries, not out of the postings.
    """
    postings = index.all_postings if postings is None else postings
    return postings_of_terms(index, postings, weighted, terms, field).select(*weighted.columns, "doc_id", "tf", "dl")


def postings_of_terms(index: Index, postings: DataFrame, weighted: DataFrame, terms: QueryTerms, field: str) -> DataFrame:
    """Rows of ``postings`` (any that have field, bucket and term) beside the weights of their terms."""
    if index.analysis.min_df > 0 and "df" not in weighted.columns:
        shown = index.of_terms(index.term_stats.where(F.col("field") == field), terms.terms).select("term")
        weighted = shown.join(F.broadcast(weighted), "term") if terms.small else sized_join(weighted, shown, ["term"], spread="query_id")
    found = index.of_terms(postings.where(F.col("field") == field), terms.terms).drop("field")
    # The bucket of a term lets the join prune directories, for batches of any size.
    keyed = weighted.withColumn("bucket", term_bucket(F.col("term"), index.num_buckets))
    df = "df" if "df" in weighted.columns else None
    on = ["bucket", "term"]
    return sized_join(found, keyed, on, spread="doc_id", small_fits=terms.small, rows=df).drop("bucket")


def with_lengths(index: Index, rows: DataFrame, field: str) -> DataFrame:
    """Matches with the length of each document: stored with its postings, for link texts that of the page they point to.

    A page that the index does not have counts as empty.
    """
    if field != ANCHOR:
        return rows
    return rows.drop("dl").join(index.doc_len, "doc_id", "left").withColumn("dl", F.coalesce("dl", F.lit(0).cast("bigint")))


def candidates(index: Index, queries: DataFrame | QueryTerms, field: str, stop: P.StopWords | None = None) -> DataFrame:
    """``(query_id, doc_id)``: documents that hold at least one term of the query."""
    terms = terms_for(index, queries, stop)
    wanted = terms.rows.select("query_id", "term")
    return matches(index, wanted, terms, field).select("query_id", "doc_id").distinct()


def holding_all_terms(
    index: Index, queries: DataFrame | QueryTerms, field: str, stop: P.StopWords | None = None
) -> DataFrame:
    """``(query_id, doc_id)``: documents that hold every distinct term of the query.

    A query with a term that the index does not have has no such document, and its terms are not looked up. All
    documents of a query's rarest term are read first. While those pairs can be broadcast, only
    they are kept of the documents of the other terms, before anything is shuffled.
    """
    terms, keys = terms_for(index, queries, stop), ["query_id", "doc_id"]
    need = terms.rows.groupBy("query_id").agg(F.count("*").alias("need"))
    known = materialize(known_terms(index, terms, field).select("query_id", "term", "df"), "known_terms")
    whole = known.groupBy("query_id").agg(F.count("*").alias("known"), F.min(F.struct("df", "term"))["term"].alias("rarest"))
    whole = materialize(whole.join(need, "query_id").where("known = need").select("query_id", "need", "rarest"), "whole_queries")
    wanted = known.join(F.broadcast(whole) if terms.small else whole, "query_id")
    first, rest = (wanted.where(by).select("query_id", "term", "df") for by in ("term = rarest", "term <> rarest"))
    # Every match is a document of a term's df.
    count = wanted.agg(F.sum("df")).first()[0] or 0
    pairs = materialize(matches(index, first, terms, field).select(*keys), "rarest_matches")
    others = matches(index, rest, terms, field).select(*keys)
    if fits_broadcast(pairs):
        count = pairs.count() * (whole.agg(F.max("need")).first()[0] or 0)
        able = F.broadcast(pairs.distinct().select(F.col("query_id").alias("_query_id"), F.col("doc_id").alias("_doc_id")))
        others = others.join(able, F.col("query_id").eqNullSafe(F.col("_query_id")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")
    held = deal_out(pairs.unionByName(others), count, *keys).groupBy(*keys).agg(F.count("*").alias("held"))
    return (
        sized_join(held, whole.select("query_id", "need"), ["query_id"], spread="doc_id")
        .where(F.col("held") == F.col("need"))
        .select("query_id", "doc_id")
    )
