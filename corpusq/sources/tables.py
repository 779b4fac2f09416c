"""Side tables in files: PageRank as CSV, saved anchors, judgments as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.sources.storage import fresh_path

# Judgment lists are written in blocks of this many consecutive document ids.
BLOCK_SPAN = 65_536

JUDGMENTS = "MAP<STRING, ARRAY<BIGINT>>"
TOKEN_LISTS = "MAP<STRING, ARRAY<STRING>>"


def read_pagerank(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, pr)`` from CSV files without a header; a malformed line is an error."""
    return spark.read.schema("doc_id BIGINT, pr DOUBLE").csv(path, mode="FAILFAST")


def write_pagerank(page_rank: DataFrame, path: str) -> None:
    """Write ``(doc_id, pr)`` as CSV files without a header."""
    page_rank.select("doc_id", "pr").write.mode("errorifexists").csv(path)


def save_anchors(anchors: DataFrame) -> str:
    """Write a table of link texts under a fresh path, and return the path."""
    path = fresh_path(anchors.sparkSession, "anchors")
    anchors.write.mode("errorifexists").parquet(path)
    return path


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved table."""
    return spark.read.parquet(path)


def read_qrels(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """``(query_text, doc_id)`` from JSON maps of query text to document ids.

    By default every line holds a map; a query may occur on several lines. With
    ``multiline`` every file holds one pretty-printed map. Anything else is an error.
    """
    maps = _json_maps(spark, path, multiline, JUDGMENTS)
    return maps.select(F.explode("m").alias("query_text", "ids")).select(
        "query_text", F.explode("ids").alias("doc_id")
    )


def _json_maps(spark: SparkSession, path: str, multiline: bool, schema: str) -> DataFrame:
    """One map ``m`` per line or file; blank ones are passed over, malformed ones fail."""
    # Spark may look for empty maps before other filters, so blank lines are told apart in the value itself.
    blank = F.trim(F.regexp_replace("value", r"\s", " ")) == ""
    parsed = F.from_json(F.when(blank, "{}").otherwise(F.col("value")), schema, {"mode": "FAILFAST"})
    wrong = F.raise_error(F.concat(F.lit("not a JSON map: "), F.substring("value", 1, 80)))
    return spark.read.text(path, wholetext=multiline).select(F.coalesce(parsed, wrong.cast(schema)).alias("m"))


def write_qrels(qrels: DataFrame, path: str) -> None:
    """Write ``(query_text, doc_id)`` as lines of JSON maps.

    The ids of a query are split by block, so no line grows with the judgments.
    """
    blocks = qrels.groupBy("query_text", F.floor(F.col("doc_id") / BLOCK_SPAN).alias("block")).agg(
        F.sort_array(F.collect_list("doc_id")).alias("ids")
    )
    lines = blocks.select(F.to_json(F.create_map("query_text", "ids")).alias("value"))
    lines.write.mode("errorifexists").text(path)


def read_token_lists(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """``(doc_id, tokens)`` from JSON maps of document id to its tokens, read as judgments are."""
    maps = _json_maps(spark, path, multiline, TOKEN_LISTS)
    return maps.select(F.explode("m").alias("id", "tokens")).select(F.col("id").cast("bigint").alias("doc_id"), "tokens")


def write_token_lists(docs: DataFrame, path: str) -> None:
    """Write ``(doc_id, tokens)`` as lines of JSON maps, one document per line."""
    line = F.to_json(F.create_map(F.col("doc_id").cast("string"), "tokens"))
    docs.select(line.alias("value")).write.mode("errorifexists").text(path)
