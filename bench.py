"""Headline timings: one JSON line on standard output.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the local cores. Every
figure is the median of three runs after a warm-up. Index builds write all index
tables; the searches run on a stored index and materialise every result row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from corpusq.operators import graph, rank
from corpusq.operators.evaluate import evaluate
from corpusq.operators.index import write_index
from corpusq.operators.postings import kept_token_rows
from corpusq.plans.search import search
from corpusq.registry import fixtures as fx
from corpusq.sources.storage import delete_path, fresh_path

RUNS = 3


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    work()
    taken = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusq-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    body_bm25 = rank.Bm25(k1=5.0, b=0.2)
    docs, queries = fx.documents(spark, sf), fx.queries(spark, sf)

    def build(corpus: DataFrame, fields: list[str], anchors: DataFrame | None = None) -> None:
        path = fresh_path(spark, "bench")
        write_index(corpus, path, fields, anchors=anchors, num_buckets=fx.NUM_BUCKETS)
        delete_path(spark, path)

    links = fx.anchors(spark, sf)
    index, pages = fx.documents_index(spark, sf), fx.pages_index(spark, sf)
    norms, qrels, page_rank = fx.norms(spark, sf), fx.qrels(spark, sf), fx.page_rank(spark, sf)
    views, titles = fx.page_views(spark, sf), fx.titles(spark, sf)
    works = {
        "tokenize": lambda: run(kept_token_rows(docs, "body")),
        "index_build_body": lambda: build(docs, ["body"]),
        "index_build_three_fields": lambda: build(fx.pages(spark, sf), ["title", "body"], links),
        "bm25_top100": lambda: run(rank.bm25(index, queries, "body", body_bm25)),
        "tfidf_dot_top100": lambda: run(rank.tfidf(index, queries)),
        "tfidf_cosine_top100": lambda: run(rank.tfidf(index, queries, norms=norms)),
        "title_match_top100": lambda: run(rank.term_match(pages, queries, "title")),
        "search_top40": lambda: run(search(pages, queries, page_rank, views, titles)),
        "evaluate": lambda: run(evaluate(rank.bm25(index, queries, "body", body_bm25), qrels)),
        "pagerank_5_steps": lambda: run(graph.pagerank(fx.links(spark, sf), 5)),
        "page_views_monthly": lambda: run(graph.monthly_page_views(fx.visits(spark, sf))),
    }
    times = {name: seconds(work) for name, work in works.items()}
    print(
        json.dumps(
            {
                "metric": "total of the median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": int(cpus),
                "documents": index.n,
                "batch_queries": queries.count(),
                "index_docs_per_sec": round(index.n / times["index_build_body"], 1),
                "bm25_queries_per_sec": round(queries.count() / times["bm25_top100"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
