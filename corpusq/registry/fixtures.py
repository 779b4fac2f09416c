"""The test tables seen as corpus, queries, judgments and page statistics.

``documents`` is a corpus with one field, ``pages`` one with title, body and
anchors, ``benchmark`` the query batch, ``events`` the page visits. Indexes and
other derived tables are stored once per session and version of their inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.operators import graph
from corpusq.operators import postings as P
from corpusq.operators.index import Index, open_index, write_index
from corpusq.operators.joins import sized_join, spread
from corpusq.operators.match import holding_all_terms
from corpusq.operators.numbering import number_values
from corpusq.sources.corpus import project_anchors, project_field, read_corpus
from corpusq.sources.storage import fresh_path, path_exists, version_of

NUM_BUCKETS = 16
PAGERANK_STEPS = 5

TITLE = "<title>(.*?)</title>"
NOT_TEXT = "(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"
TAG = "<[^>]*>"
LINK = '<a href="([^"]*)">([^<]*)</a>'

_stored: dict[tuple, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_corpus(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, body, lang)``."""
    return table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"), "lang")


def queries(spark: SparkSession, sf: str) -> DataFrame:
    """``(query_id, text)``."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, title, body, anchors)`` taken out of the raw pages."""
    raw = spread(table(spark, sf, "pages").select("page_id", "html"), "page_id")
    html = F.col("html")
    text = F.regexp_replace(F.regexp_replace(html, NOT_TEXT, " "), TAG, " ")
    links = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(LINK), F.lit(1)).alias("href"),
        F.regexp_extract_all(html, F.lit(LINK), F.lit(2)).alias("text"),
    )
    return raw.select(
        F.col("page_id").alias("doc_id"),
        F.regexp_extract(html, TITLE, 1).alias("title"),
        text.alias("body"),
        links.alias("anchors"),
    )


def anchors(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, target_id, text)``: links, with their targets numbered by address."""

    def build(path: str) -> None:
        links = project_anchors(pages(spark, sf))
        numbers = number_values(links, "href", "target_id")
        numbered = sized_join(links, numbers, ["href"], spread="doc_id")
        numbered.select("doc_id", "target_id", "text").write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "anchors", ["pages"], build))


def documents_index(spark: SparkSession, sf: str) -> Index:
    def build(path: str) -> None:
        write_index(documents(spark, sf), path, ["body"], num_buckets=NUM_BUCKETS)

    return open_index(spark, stored(spark, sf, "documents-index", ["documents"], build))


def pages_index(spark: SparkSession, sf: str) -> Index:
    def build(path: str) -> None:
        links = anchors(spark, sf)
        write_index(pages(spark, sf), path, ["title", "body"], anchors=links, num_buckets=NUM_BUCKETS)

    return open_index(spark, stored(spark, sf, "pages-index", ["pages"], build))


def norms(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, norm, weight_norm)`` of the documents."""

    def build(path: str) -> None:
        index = documents_index(spark, sf)
        P.document_norms(index.postings, index.term_stats, index.n).write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "norms", ["documents"], build))


def qrels(spark: SparkSession, sf: str) -> DataFrame:
    """``(query_id, doc_id)``: a document is relevant if it holds every query term."""

    def build(path: str) -> None:
        holding_all_terms(documents_index(spark, sf), queries(spark, sf), "body").write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "qrels", ["documents", "benchmark"], build))


def page_qrels(spark: SparkSession, sf: str) -> DataFrame:
    """``(query_id, doc_id)``: a page is relevant if its body holds every query term."""

    def build(path: str) -> None:
        holding_all_terms(pages_index(spark, sf), queries(spark, sf), "body").write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "page-qrels", ["pages", "benchmark"], build))


def links(spark: SparkSession, sf: str) -> DataFrame:
    """``(src, dst)`` of the page links."""
    return anchors(spark, sf).select(F.col("doc_id").alias("src"), F.col("target_id").alias("dst"))


def page_rank(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, pr)``."""

    def build(path: str) -> None:
        graph.pagerank(links(spark, sf), PAGERANK_STEPS).write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "page-rank", ["pages"], build))


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """``(request_id, pos, doc_id, ts)``: the page views of the event log."""
    events = table(spark, sf, "events").where(F.col("event_type") == "view")
    return events.select(
        F.col("user_id").alias("request_id"),
        F.col("event_id").alias("pos"),
        F.get_json_object("props", "$.k").cast("bigint").alias("doc_id"),
        "ts",
    )


def page_views(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, views)`` over all months."""

    def build(path: str) -> None:
        graph.total_page_views(graph.monthly_page_views(visits(spark, sf))).write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "page-views", ["events"], build))


def titles(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, title)`` of the pages."""

    def build(path: str) -> None:
        project_field(pages(spark, sf), "title").write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "titles", ["pages"], build))


def lemmas(index: Index) -> DataFrame:
    """``(form, lemma)``: a stand-in dictionary that cuts off common endings."""
    return index.term_stats.select(
        F.col("term").alias("form"), F.regexp_replace("term", "(ing|ed|s)$", "").alias("lemma")
    ).where("length(lemma) > 0")


def stored(spark: SparkSession, sf: str, name: str, inputs: list[str], build: Callable[[str], None]) -> str:
    """Path of a derived table, built when its inputs are new or it is gone."""
    versions = tuple(version_of(spark, f"{sf}/{i}.parquet") for i in inputs)
    key = (spark.sparkContext.applicationId, sf, name, versions)
    if key not in _stored or not path_exists(spark, _stored[key]):
        path = fresh_path(spark, name)
        build(path)
        _stored[key] = path
    return _stored[key]
