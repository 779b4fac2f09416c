"""The corpus: reading it, projecting its fields, selecting documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.operators.joins import sized_join
from corpusq.sources.storage import fresh_path


def read_corpus(spark: SparkSession, *paths: str) -> DataFrame:
    """All parquet files of some directories, globs or files as one table."""
    return spark.read.parquet(*paths)


def project_field(corpus: DataFrame, field: str) -> DataFrame:
    """``(doc_id, field)``; the scan reads no other column."""
    return corpus.select("doc_id", field)


def project_anchors(corpus: DataFrame) -> DataFrame:
    """``(doc_id, …)``: one row per link, with the columns of the ``anchors`` structs."""
    links = corpus.select("doc_id", F.explode_outer("anchors").alias("a"))
    return links.where(F.col("a").isNotNull()).select("doc_id", "a.*")


def unpivot_fields(corpus: DataFrame, fields: Sequence[str] = ("title", "body")) -> DataFrame:
    """``(doc_id, field, text)``: one row per document and text field, from one scan."""
    return corpus.unpivot("doc_id", list(fields), "field", "text")


def select_documents(corpus: DataFrame, ids: DataFrame, path: str | None = None) -> DataFrame:
    """Documents whose id is listed, written as parquet and read back.

    A list of moderate size is broadcast, so that the texts stay where they are.
    """
    path = path or fresh_path(corpus.sparkSession, "selected")
    kept = sized_join(corpus, ids.select("doc_id"), ["doc_id"], "left_semi", spread="doc_id")
    kept.write.mode("errorifexists").parquet(path)
    return corpus.sparkSession.read.schema(corpus.schema).parquet(path)


def titles(corpus: DataFrame) -> DataFrame:
    """``(doc_id, title)``."""
    return project_field(corpus, "title")
