"""One query per operator over the test tables.

Operators keep full precision; doubles that are not rounded by definition are
rounded here, because the last bits depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.functions import typed
from corpusq.functions.text import kept_tokens, term_bucket
from corpusq.functions.weights import half_even, idf, idf_bm25
from corpusq.operators import evaluate as E
from corpusq.operators import fuse, graph, match, rank
from corpusq.operators import index as ix
from corpusq.operators import norms as N
from corpusq.operators import postings as P
from corpusq.operators.joins import sized_join, spread
from corpusq.operators.numbering import number_values
from corpusq.plans import search as S
from corpusq.registry import fixtures as fx
from corpusq.sources import corpus as C
from corpusq.sources import tables as T
from corpusq.sources.storage import fresh_path, materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TITLE_BM25 = rank.Bm25(k1=2.0, b=0.05)
BODY_BM25 = rank.Bm25(k1=5.0, b=0.2)


def register(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _six(column: str) -> Column:
    return half_even(F.col(column), 6).alias(column)


def _joined(entries: str, left: str, right: str) -> Column:
    """A list of pairs as text, ``left:right left:right``."""
    pairs = F.transform(entries, lambda e: F.concat_ws(":", e[left].cast("string"), e[right].cast("string")))
    return F.array_join(pairs, " ").alias(entries)


def _body_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Postings of the documents, straight from the text."""
    return P.postings_of(P.document_terms(fx.documents(spark, sf), ["body"]), ["body"])


# Sources and sinks


@register
def corpus_scan(spark, sf):
    return C.read_corpus(spark, f"{sf}/documents.parquet")


@register
def project_body(spark, sf):
    return C.project_field(fx.pages(spark, sf), "body")


@register
def project_title(spark, sf):
    return C.project_field(fx.pages(spark, sf), "title")


@register
def project_anchor(spark, sf):
    return C.project_anchors(fx.pages(spark, sf))


@register
def fields_unpivot(spark, sf):
    return C.unpivot_fields(fx.pages(spark, sf))


@register
def select_docs(spark, sf):
    listed = fx.table(spark, sf, "labels").select("doc_id")
    return C.select_documents(fx.documents(spark, sf), listed)


@register
def qrels_load(spark, sf):
    judged = fx.qrels(spark, sf).join(fx.queries(spark, sf), "query_id")
    path = fresh_path(spark, "qrels-json")
    T.write_qrels(judged.select(F.col("text").alias("query_text"), "doc_id"), path)
    return T.read_qrels(spark, path)


@register
def pagerank_csv(spark, sf):
    path = fresh_path(spark, "page-rank-csv")
    T.write_pagerank(fx.page_rank(spark, sf), path)
    return T.read_pagerank(spark, path).select("doc_id", half_even(F.col("pr"), 8).alias("pr"))


@register
def anchor_roundtrip(spark, sf):
    return T.load_table(spark, T.save_anchors(fx.anchors(spark, sf)))


@register
def index_roundtrip(spark, sf):
    index = fx.documents_index(spark, sf)
    return index.postings.select("field", "bucket", "term", "doc_id", "tf", "dl")


@register
def index_rebuild(spark, sf):
    path = fresh_path(spark, "rebuilt")
    ix.write_index(fx.pages(spark, sf), path, ["body"], num_buckets=fx.NUM_BUCKETS)
    index = ix.write_index(fx.documents(spark, sf), path, ["body"], num_buckets=fx.NUM_BUCKETS)
    return index.term_stats.select("term", "df", "cf")


@register
def posting_lists(spark, sf):
    lists = P.posting_lists(fx.documents_index(spark, sf).postings)
    return lists.select("term", "block", _joined("postings", "doc_id", "tf"))


@register
def posting_lists_equal(spark, sf):
    """Lists of ids that lie far apart, in blocks of up to 50 rows."""
    postings = fx.documents_index(spark, sf).postings.withColumn("doc_id", F.col("doc_id") * 65_536_000_003)
    lists = P.equal_posting_lists(postings, 50)
    return lists.select("term", "block", _joined("postings", "doc_id", "tf"))


@register
def term_lookup(spark, sf):
    index = fx.documents_index(spark, sf)
    terms = match.measured_terms(fx.queries(spark, sf))
    wanted = terms.rows.select("query_id", "term")
    return match.matches(index, wanted, terms, "body").select("query_id", "term", "doc_id", "tf")


# Text


@register
def tokenize(spark, sf):
    return P.token_rows(fx.documents(spark, sf), "body")


@register
def stop_filter(spark, sf):
    return P.kept_token_rows(fx.documents(spark, sf), "body")


@register
def lemma_tf(spark, sf):
    index = fx.documents_index(spark, sf)
    return P.lemma_postings(index.postings, fx.lemmas(index)).select("term", "doc_id", "tf")


@register
def lemma_binary_tf(spark, sf):
    index = fx.documents_index(spark, sf)
    return P.lemma_postings(index.postings, fx.lemmas(index), binary_tf=True).select("term", "doc_id", "tf")


@register
def typed_tokens(spark, sf):
    docs = spread(fx.documents(spark, sf).select("doc_id", "body"), "doc_id")
    found = docs.select("doc_id", F.posexplode_outer(typed.typed_tokens(F.col("body"))).alias("pos", "t"))
    return found.where(F.col("pos").isNotNull()).select("doc_id", "pos", "t.token", "t.cls")


@register
def token_class_counts(spark, sf):
    docs = spread(fx.documents(spark, sf).select("doc_id", "body"), "doc_id")
    found = docs.select("doc_id", typed.typed_tokens(F.col("body")).alias("found"))
    return found.select("doc_id", *typed.class_counts(F.col("found")))


@register
def extract_dates(spark, sf):
    day = F.col("o_orderdate")
    text = F.concat_ws(
        " ", F.date_format(day, "d MMMM yyyy"), F.lit("or"), F.date_format(day, "MMMM d, yyyy"), F.lit("at noon")
    )
    orders = fx.table(spark, sf, "orders").select("o_orderkey", F.explode_outer(typed.extract_dates(text)).alias("date"))
    return orders.where(F.col("date").isNotNull())


@register
def extract_times(spark, sf):
    text = F.concat(
        F.lit("seen "), F.date_format("ts", "H:mm:ss"), F.lit(" or "), F.date_format("ts", "h.mm"), F.lit("PM today")
    )
    events = fx.table(spark, sf, "events").select("event_id", F.explode_outer(typed.extract_times(text)).alias("time"))
    return events.where(F.col("time").isNotNull())


@register
def term_bucket_of_terms(spark, sf):
    stats = fx.documents_index(spark, sf).term_stats
    return stats.select("term", term_bucket(F.col("term"), 124).alias("bucket"))


QUERIES["term_bucket"] = QUERIES.pop("term_bucket_of_terms")


# Counts and statistics


@register
def term_freq(spark, sf):
    return _body_postings(spark, sf).select("term", "doc_id", "tf")


@register
def doc_freq(spark, sf):
    return P.term_statistics(_body_postings(spark, sf)).select("term", "df")


@register
def coll_freq(spark, sf):
    return P.term_statistics(_body_postings(spark, sf)).select("term", "cf")


@register
def min_df_postings(spark, sf):
    postings = fx.documents_index(spark, sf).postings
    return P.frequent_terms_only(postings, min_df=50).select("term", "doc_id", "tf")


@register
def corpus_stats(spark, sf):
    stats = fx.documents_index(spark, sf).corpus_stats()
    return stats.select("n", "total_len", _six("avg_dl"))


@register
def doc_lengths(spark, sf):
    return P.document_terms(fx.documents(spark, sf), ["body"]).select("doc_id", "dl")


@register
def doc_norms(spark, sf):
    return fx.norms(spark, sf).select("doc_id", _six("norm"), _six("weight_norm"))


@register
def norms_after_append(spark, sf):
    """Norms brought up to date from the terms that an append has changed."""
    docs, path = fx.documents(spark, sf), fresh_path(spark, "grown")
    base = ix.write_index(docs.where("not lang <=> 'de'"), path, ["body"], num_buckets=fx.NUM_BUCKETS)
    sums = materialize(N.norm_sums(base), "norm_sums")
    grown = ix.append_documents(base, docs.where("lang <=> 'de'"))
    found = N.norms_of(N.norm_sums_after_append(sums, base, grown), grown.n)
    return found.select("doc_id", _six("norm"), _six("weight_norm"))


@register
def index_append(spark, sf):
    docs, path = fx.documents(spark, sf), fresh_path(spark, "grown")
    base = ix.write_index(docs.where("not lang <=> 'de'"), path, ["body"], num_buckets=fx.NUM_BUCKETS)
    grown = ix.append_documents(base, docs.where("lang <=> 'de'"))
    n, total_len = (F.lit(v).cast("bigint") for v in (grown.n, grown.total_len))
    return grown.term_stats.select("term", "df", "cf", n.alias("n"), total_len.alias("total_len"))


@register
def index_append_min_df(spark, sf):
    """Terms that pass the limit only by the append are there with all their documents."""
    docs, path = fx.documents(spark, sf), fresh_path(spark, "grown")
    base = ix.write_index(docs.where("not lang <=> 'de'"), path, ["body"], min_df=50, num_buckets=fx.NUM_BUCKETS)
    grown = ix.append_documents(base, docs.where("lang <=> 'de'"))
    return grown.postings.select("term", "doc_id", "tf", "dl")


def _with_stats(index: ix.Index) -> DataFrame:
    keys = ["field", "bucket", "term"]
    rows = sized_join(index.postings, index.term_stats, keys, spread="doc_id", rows="df")
    return rows.select("field", "term", "doc_id", "tf", "dl", "df", "cf")


@register
def index_append_three_fields(spark, sf):
    """Title, body and link texts grow by a batch of pages; links of both batches point to the same pages."""
    pages, links, path = fx.pages(spark, sf), fx.anchors(spark, sf), fresh_path(spark, "grown")
    late = F.col("doc_id") % 3 == 0
    base = ix.write_index(pages.where(~late), path, ["title", "body"], anchors=links.where(~late), num_buckets=fx.NUM_BUCKETS)
    return _with_stats(ix.append_documents(base, pages.where(late), anchors=links.where(late)))


@register
def index_compact(spark, sf):
    """Three batches merged into one."""
    docs, path = fx.documents(spark, sf), fresh_path(spark, "grown")
    index = ix.write_index(docs.where("lang <=> 'en'"), path, ["body"], num_buckets=fx.NUM_BUCKETS)
    for more in ("lang <=> 'de'", "not lang <=> 'en' and not lang <=> 'de'"):
        index = ix.append_documents(index, docs.where(more))
    index = ix.compact_index(index)
    batches = F.lit(len(index.parts)).cast("bigint")
    return _with_stats(index).select("*", batches.alias("batches"))


@register
def index_append_tokens(spark, sf):
    docs, path = fx.documents(spark, sf), fresh_path(spark, "grown")
    base = ix.write_index(docs.where("not lang <=> 'de'"), path, ["body"], num_buckets=fx.NUM_BUCKETS)
    batch = docs.where("lang <=> 'de'").select("doc_id", kept_tokens(F.col("body")).alias("tokens"))
    file = fresh_path(spark, "tokens-json")
    T.write_token_lists(batch, file)
    grown = ix.append_documents(base, T.read_token_lists(spark, file).withColumnRenamed("tokens", "body"))
    return grown.postings.select("term", "doc_id", "tf", "dl")


@register
def bucket_sizes(spark, sf):
    return ix.bucket_sizes(fx.documents_index(spark, sf), "body")


@register
def query_tf(spark, sf):
    return match.query_terms(fx.queries(spark, sf)).select("query_id", "term", "qtf", "qlen")


@register
def sparse_rows(spark, sf):
    index = fx.documents_index(spark, sf)
    columns = number_values(index.term_stats, "term", "term_idx")
    cells = sized_join(index.postings, columns, ["term"], spread="doc_id")
    rows = P.sparse_rows(cells.select("doc_id", "term_idx", F.col("tf").alias("value")), "doc_id")
    return rows.select("doc_id", "block", _joined("entries", "term_idx", "value"))


@register
def sparse_query(spark, sf):
    index = fx.documents_index(spark, sf)
    columns = number_values(index.term_stats, "term", "term_idx")
    terms = match.measured_terms(fx.queries(spark, sf))
    known = match.known_terms(index, terms, "body").select("query_id", "term", "qtf")
    return sized_join(known, columns, ["term"], spread="query_id").where("qtf <> 0").select(
        "query_id", "term_idx", F.col("qtf").alias("value")
    )


@register
def anchor_postings(spark, sf):
    return P.anchor_postings(fx.anchors(spark, sf)).select("term", "doc_id", "tf")


@register
def anchor_postings_stop_table(spark, sf):
    """The words of all queries as a stop table that is joined, not written out as literals."""
    words = P.kept_token_rows(fx.queries(spark, sf), "text", [], "query_id").select("term")
    return P.anchor_postings(fx.anchors(spark, sf), words, stop_literals=0).select("term", "doc_id", "tf")


@register
def title_postings(spark, sf):
    counted = P.document_terms(fx.pages(spark, sf), ["title"], is_scan=False)
    return P.postings_of(counted, ["title"]).select("term", "doc_id", "tf")


@register
def titles(spark, sf):
    return C.titles(fx.pages(spark, sf))


# Weights and ranking


@register
def tfidf_raw(spark, sf):
    index = fx.documents_index(spark, sf)
    weight = F.col("tf") * idf(float(index.n), F.col("df"))
    stats = index.term_stats.select("term", "df")
    rows = sized_join(index.postings, stats, ["term"], spread="doc_id", rows="df")
    return rows.select("term", "doc_id", half_even(weight, 6).alias("weight"))


@register
def tfidf_candidates(spark, sf):
    rows = rank.tfidf_candidates(fx.documents_index(spark, sf), fx.queries(spark, sf))
    return rows.select("query_id", "doc_id", "term", half_even(F.col("weight"), 8).alias("weight"))


@register
def query_vec(spark, sf):
    terms = match.measured_terms(fx.queries(spark, sf))
    vectors = rank.query_vectors(fx.documents_index(spark, sf), terms, "body")
    return vectors.select("query_id", "term", half_even(F.col("weight"), 8).alias("weight"))


@register
def tfidf_dot(spark, sf):
    return rank.tfidf_scores(fx.documents_index(spark, sf), fx.queries(spark, sf))


@register
def tfidf_topk(spark, sf):
    return rank.tfidf(fx.documents_index(spark, sf), fx.queries(spark, sf), n=3)


@register
def title_tfidf_topk(spark, sf):
    return rank.tfidf(fx.pages_index(spark, sf), fx.queries(spark, sf), "title", n=20)


@register
def anchor_tfidf_topk(spark, sf):
    """Pages by the texts of the links to them; a page that is not there has length 0."""
    return rank.tfidf(fx.pages_index(spark, sf), fx.queries(spark, sf), "anchor", n=20)


@register
def tfidf_cosine(spark, sf):
    index, norms = fx.documents_index(spark, sf), fx.norms(spark, sf)
    return rank.tfidf(index, fx.queries(spark, sf), n=100, norms=norms)


@register
def bm25_idf(spark, sf):
    index = fx.documents_index(spark, sf)
    weight = idf_bm25(float(index.n), F.col("df"))
    return index.term_stats.select("term", half_even(weight, 6).alias("idf"))


@register
def candidates(spark, sf):
    return match.candidates(fx.documents_index(spark, sf), fx.queries(spark, sf), "body")


@register
def bm25_scores(spark, sf):
    return rank.bm25_scores(fx.documents_index(spark, sf), fx.queries(spark, sf))


@register
def bm25_topk(spark, sf):
    return rank.bm25(fx.documents_index(spark, sf), fx.queries(spark, sf), "body", BODY_BM25)


@register
def bm25_topk_pruned(spark, sf):
    """The ten best by block bounds, without scoring every match."""
    return rank.bm25(fx.documents_index(spark, sf), fx.queries(spark, sf), "body", BODY_BM25, 10, prune=True)


@register
def bm25_topk_by_document(spark, sf):
    """Scores from postings laid out by document, without a shuffle of matches."""
    index = fx.documents_index(spark, sf)
    if ix.postings_by_document(index, "body") is None:
        ix.lay_out_by_document(index, "body")
    scores = rank.bm25_scores(index, fx.queries(spark, sf), "body", BODY_BM25, postings=ix.postings_by_document(index, "body"))
    return rank.top_k(scores, 100)


@register
def title_tf_sum(spark, sf):
    return rank.term_match(fx.pages_index(spark, sf), fx.queries(spark, sf), "title", "tf_sum")


@register
def title_distinct(spark, sf):
    return rank.term_match(fx.pages_index(spark, sf), fx.queries(spark, sf), "title", "distinct_terms", None)


@register
def anchor_tf_sum(spark, sf):
    return rank.term_match(fx.pages_index(spark, sf), fx.queries(spark, sf), "anchor", "tf_sum")


@register
def anchor_distinct(spark, sf):
    return rank.term_match(fx.pages_index(spark, sf), fx.queries(spark, sf), "anchor", "distinct_terms", None)


@register
def search_body(spark, sf):
    return S.search_body(fx.pages_index(spark, sf), fx.queries(spark, sf), fx.titles(spark, sf))


@register
def attach_titles(spark, sf):
    return S.search_anchor(fx.pages_index(spark, sf), fx.queries(spark, sf), fx.titles(spark, sf))


@register
def search_title(spark, sf):
    """All pages with query words in their title, by how many different ones."""
    return S.search_title(fx.pages_index(spark, sf), fx.queries(spark, sf), fx.titles(spark, sf), "distinct_terms", None)


@register
def search_anchor(spark, sf):
    """All pages with query words in the links to them, by how many different ones."""
    return S.search_anchor(fx.pages_index(spark, sf), fx.queries(spark, sf), fx.titles(spark, sf), "distinct_terms", None)


@register
def merge_ranked(spark, sf):
    profiles = {"title": TITLE_BM25, "body": BODY_BM25}
    ranked = rank.bm25_fields(fx.pages_index(spark, sf), fx.queries(spark, sf), profiles)
    weights = {"title": 0.5, "body": 0.5}
    return fuse.merge_fields(ranked, weights, fx.page_rank(spark, sf), fx.page_views(spark, sf))


@register
def search(spark, sf):
    return S.search(
        fx.pages_index(spark, sf),
        fx.queries(spark, sf),
        fx.page_rank(spark, sf),
        fx.page_views(spark, sf),
        fx.titles(spark, sf),
    )


@register
def lookup_pagerank(spark, sf):
    found = fuse.lookup_values(fx.visits(spark, sf), fx.page_rank(spark, sf), "pr", aligned=False)
    return found.withColumn("pr", half_even(F.col("pr"), 8))


@register
def lookup_pagerank_aligned(spark, sf):
    found = fuse.lookup_values(fx.visits(spark, sf), fx.page_rank(spark, sf), "pr")
    return found.withColumn("pr", half_even(F.col("pr"), 8))


@register
def lookup_pageviews(spark, sf):
    wanted = fx.links(spark, sf).select(
        F.col("src").alias("request_id"), F.col("dst").alias("pos"), F.col("dst").alias("doc_id")
    )
    return fuse.lookup_values(wanted, fx.page_views(spark, sf), "views", default=0)


@register
def page_views_monthly(spark, sf):
    monthly = graph.monthly_page_views(fx.visits(spark, sf))
    return monthly.select("doc_id", F.date_format("month", "yyyy-MM").alias("month"), "views")


@register
def page_views_of_month(spark, sf):
    return graph.page_views_of(graph.monthly_page_views(fx.visits(spark, sf)), "2024-01")


@register
def pagerank(spark, sf):
    return fx.page_rank(spark, sf).select("doc_id", half_even(F.col("pr"), 8).alias("pr"))


@register
def pagerank_converged(spark, sf):
    found = graph.pagerank_to_tolerance(fx.links(spark, sf), tolerance=1e-8)
    return found.select("doc_id", half_even(F.col("pr"), 6).alias("pr"))


# Evaluation


def _results(spark: SparkSession, sf: str) -> DataFrame:
    return rank.bm25(fx.documents_index(spark, sf), fx.queries(spark, sf), "body", BODY_BM25)


def _evaluated(spark: SparkSession, sf: str) -> DataFrame:
    return E.evaluate(_results(spark, sf), fx.qrels(spark, sf))


def _metric(name: str) -> Query:
    return lambda spark, sf: _evaluated(spark, sf).select("query_id", _six(name))


for _name in E.METRICS:
    QUERIES[_name] = _metric(_name)


@register
def rel_intersection(spark, sf):
    return E.relevant_hits(_results(spark, sf), fx.qrels(spark, sf))


@register
def evaluate(spark, sf):
    return _evaluated(spark, sf).select("query_id", *[_six(m) for m in E.METRICS])


@register
def evaluate_k10(spark, sf):
    found = E.evaluate(_results(spark, sf), fx.qrels(spark, sf), k=10)
    return found.select("query_id", *[_six(m) for m in E.METRICS])


@register
def evaluate_mean(spark, sf):
    return E.mean_metrics(_evaluated(spark, sf)).select(*[_six(m) for m in E.METRICS])


@register
def batch_eval(spark, sf):
    return S.batch_evaluation(_results(spark, sf), fx.qrels(spark, sf), fx.queries(spark, sf))


@register
def search_eval(spark, sf):
    """The combined search against the judged pages."""
    scored = E.evaluate(QUERIES["search"](spark, sf), fx.page_qrels(spark, sf))
    return scored.select("query_id", *[_six(m) for m in E.METRICS])
