"""Rankers, merging, evaluation and page statistics against plain definitions."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusq.operators import evaluate as E
from corpusq.operators import fuse, graph, match, rank
from corpusq.operators import index as ix
from corpusq.operators import postings as P
from corpusq.plans import search as S
from corpusq.sources import corpus as C
from corpusq.sources import tables as T

DOCS = [
    (1, "green tea", "green tea leaves and hot water"),
    (2, "black tea", "black tea is tea"),
    (3, "the", "the and of"),
    (4, "coffee", "hot coffee hot milk sugar sugar sugar"),
    (5, "tea tea", "water water everywhere"),
]
QUERIES = [
    (10, "tea"),
    (11, "hot hot tea zzz"),
    (12, "the of"),
    (13, "zzz unknown"),
    (14, "water sugar green"),
]
KEPT = {d: [w for w in body.split() if w not in {"and", "is", "the", "of"}] for d, _, body in DOCS}
ASKED = {10: ["tea"], 11: ["hot", "hot", "tea", "zzz"], 12: [], 13: ["zzz", "unknown"], 14: ["water", "sugar", "green"]}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, "doc_id BIGINT, title STRING, body STRING")
    anchors = spark.createDataFrame([(2, "tea tea"), (1, "green tea"), (99, "hot tea")], "target_id BIGINT, text STRING")
    path = str(tmp_path_factory.mktemp("rank") / "index")
    return ix.write_index(docs, path, ["title", "body"], anchors=anchors, num_buckets=4)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id BIGINT, text STRING")


def rows(df, *names):
    return {tuple(r) for r in df.select(*names).collect()}


def plain_bm25(k1, b):
    n, avg = len(KEPT), sum(map(len, KEPT.values())) / len(KEPT)
    df = Counter(t for words in KEPT.values() for t in set(words))
    out = {}
    for q, asked in ASKED.items():
        for d, words in KEPT.items():
            shared = [t for t in asked if t in words]
            if shared:
                out[q, d] = sum(
                    math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * words.count(t) * (k1 + 1)
                    / (words.count(t) + k1 * (1 - b + b * len(words) / avg))
                    for t in shared
                )
    return out


@pytest.mark.parametrize("k1,b", [(1.5, 0.75), (5.0, 0.2), (2.0, 0.05)])
def test_bm25(index, queries, k1, b):
    got = {(q, d): s for q, d, s in rows(rank.bm25_scores(index, queries, "body", rank.Bm25(k1, b)), "query_id", "doc_id", "score")}
    want = plain_bm25(k1, b)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=5.1e-5) for k in want)


def test_bm25_with_other_lengths(spark, index, queries):
    same = rank.bm25_scores(index, queries, doc_len=index.doc_len)
    assert rows(same, "query_id", "doc_id", "score") == rows(rank.bm25_scores(index, queries), "query_id", "doc_id", "score")
    # Documents without a length count as empty.
    partial = rank.bm25_scores(index, queries, doc_len=index.doc_len.where("doc_id <> 2"))
    assert rows(partial.where("query_id = 10"), "doc_id") == {(1,), (2,)}


def test_repeated_query_word_counts_again(index, spark):
    one = spark.createDataFrame([(1, "hot"), (2, "hot hot")], "query_id BIGINT, text STRING")
    scores = {(r.query_id, r.doc_id): r.score for r in rank.bm25_scores(index, one).collect()}
    assert scores[2, 4] == pytest.approx(2 * scores[1, 4], abs=1e-4)


def test_top_k_ranks_by_score_then_id(spark):
    scored = spark.createDataFrame(
        [(1, 5, 1.0), (1, 3, 1.0), (1, 4, 2.0), (2, 1, 0.0)], "query_id INT, doc_id INT, score DOUBLE"
    )
    assert rows(rank.top_k(scored, 2), "query_id", "doc_id", "rank") == {(1, 4, 1), (1, 3, 2), (2, 1, 1)}


def test_large_k_gives_the_same_ranking(spark):
    scored = spark.range(5000).select(
        F.lit(1).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 97).cast("double").alias("score")
    )
    plain = rows(rank._ranked(scored, 2500, ("query_id",)), "doc_id", "score", "rank")
    assert rows(rank.top_k(scored, 2500), "doc_id", "score", "rank") == plain and len(plain) == 2500


def test_queries_without_known_terms_give_no_rows(index, queries):
    found = {q for (q,) in rows(rank.bm25(index, queries), "query_id")}
    assert found == {10, 11, 14}


def test_tfidf_dot_and_cosine(index, queries):
    n = len(KEPT)
    df = Counter(t for words in KEPT.values() for t in set(words))
    idf = {t: math.log(n / df[t] + 1e-9) for t in df}
    doc = {d: {t: words.count(t) / len(words) * idf[t] for t in words} for d, words in KEPT.items()}
    want, cosine = {}, {}
    for q, asked in ASKED.items():
        vector = {t: asked.count(t) / len(asked) * idf[t] for t in asked if t in df}
        for d in doc:
            if set(vector) & set(doc[d]):
                dot = sum(w * doc[d].get(t, 0) for t, w in vector.items())
                want[q, d] = dot
                size = math.dist([*vector.values()], [0] * len(vector)) * math.dist([*doc[d].values()], [0] * len(doc[d]))
                cosine[q, d] = dot / size
    got = {(q, d): s for q, d, s in rows(rank.tfidf_scores(index, queries), "query_id", "doc_id", "score")}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=5.1e-6) for k in want)
    body = index.postings.where("field = 'body'")
    norms = P.document_norms(body, index.term_stats.where("field = 'body'"), index.n)
    got = {(q, d): s for q, d, s in rows(rank.tfidf_scores(index, queries, norms=norms), "query_id", "doc_id", "score")}
    assert all(got[k] == pytest.approx(cosine[k], abs=5.1e-6) for k in cosine)
    assert all(0 <= s <= 1 + 1e-9 for s in got.values())


def test_query_vector_length_counts_unknown_words(index, queries):
    vectors = rank.query_vectors(index, match.measured_terms(queries), "body")
    got = {(q, t): w for q, t, w in rows(vectors, "query_id", "term", "weight")}
    assert set(got) == {(10, "tea"), (11, "hot"), (11, "tea"), (14, "water"), (14, "sugar"), (14, "green")}
    assert got[11, "hot"] == pytest.approx(2 / 4 * math.log(5 / 2 + 1e-9))


def test_title_and_anchor_matches(index, queries):
    by_tf = rank.term_match(index, queries, "title", "tf_sum").where("query_id = 10")
    assert rows(by_tf, "doc_id", "score", "rank") == {(5, 2, 1), (1, 1, 2), (2, 1, 3)}
    distinct = rank.term_match(index, queries, "title", "distinct_terms").where("query_id = 10")
    assert rows(distinct, "doc_id", "score", "rank") == {(1, 1, 1), (2, 1, 2), (5, 1, 3)}
    anchor = rank.term_match(index, queries, "anchor", "tf_sum").where("query_id = 11")
    assert rows(anchor, "doc_id", "score", "rank") == {(99, 3, 1), (2, 2, 2), (1, 1, 3)}


def test_all_matches_come_in_order(index, queries):
    every = rank.term_match(index, queries, "title", "tf_sum", limit=None).collect()
    assert [(r.query_id, r.doc_id, r.rank) for r in every][:3] == [(10, 5, 1), (10, 1, 2), (10, 2, 3)]
    assert len(every) == rank.term_match(index, queries, "title", "tf_sum").count()


def test_ranks_of_all_rows_span_partitions(spark):
    scored = spark.range(3000).select((F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 7).alias("score"))
    assert rows(rank.rank_all(scored), "doc_id", "rank") == rows(rank._ranked(scored, 3000, ("query_id",)), "doc_id", "rank")


def test_views_of_one_month(spark):
    days = [(1, "2024-01-31"), (1, "2024-01-01"), (1, "2024-02-01"), (2, "2024-02-29")]
    monthly = graph.monthly_page_views(spark.createDataFrame(days, "doc_id INT, ts STRING").withColumn("ts", F.col("ts").cast("timestamp")))
    assert rows(graph.page_views_of(monthly, "2024-02"), "doc_id", "views") == {(1, 1), (2, 1)}


def test_all_terms_held(index, queries):
    assert rows(match.holding_all_terms(index, queries, "body"), "query_id", "doc_id") == {(10, 1), (10, 2)}


def test_matches_are_grouped_by_more_tasks_as_they_grow(index, queries, monkeypatch):
    from corpusq.operators import joins

    dealt = []
    monkeypatch.setattr(match, "deal_out", lambda rows, count, *keys: dealt.append((count, keys)) or joins.deal_out(rows, count, *keys))
    assert rows(match.holding_all_terms(index, queries, "body"), "query_id", "doc_id") == {(10, 1), (10, 2)}
    matches = match.matches(index, match.query_terms(queries).select("query_id", "term"), match.terms_for(index, queries), "body").count()
    assert dealt == [(matches, ("query_id", "doc_id"))]


def test_merge_is_the_full_outer_join(spark):
    ranked = spark.createDataFrame(
        [("title", 1, 1, 2.0), ("title", 1, 2, 1.0), ("body", 1, 2, 3.0), ("body", 1, 3, 4.0)],
        "field STRING, query_id INT, doc_id BIGINT, score DOUBLE",
    )
    page_rank = spark.createDataFrame([(1, 10.0), (3, 0.0)], "doc_id BIGINT, pr DOUBLE")
    views = spark.createDataFrame([(2, 4)], "doc_id BIGINT, views BIGINT")
    merged = fuse.merge_fields(ranked, {"title": 0.3, "body": 0.7}, page_rank, views, rank_weight=0.1, view_weight=0.5, n=3)
    assert rows(merged, "doc_id", "score", "rank") == {(2, 4.4, 1), (3, 2.8, 2), (1, 1.6, 3)}
    damped = fuse.merge_fields(
        ranked, {"title": 0.3, "body": 0.7}, page_rank, views, rank_weight=1.0, view_weight=0.0, n=1, boost=F.log1p
    )
    assert rows(damped, "doc_id", "score") == {(1, round(0.6 + math.log(11), 4))}


def test_combined_search(spark, index, queries):
    page_rank = spark.createDataFrame([(4, 0.5)], "doc_id BIGINT, pr DOUBLE")
    views = spark.createDataFrame([(4, 3)], "doc_id BIGINT, views BIGINT")
    titles = spark.createDataFrame([(d, t) for d, t, _ in DOCS if d != 2], "doc_id BIGINT, title STRING")
    found = S.search(index, queries, page_rank, views, titles)
    by_query = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        by_query[r.query_id].append(r)
    assert set(by_query) == {10, 11, 14}
    for hits in by_query.values():
        assert [h.rank for h in hits] == list(range(1, len(hits) + 1))
        assert [h.score for h in hits] == sorted((h.score for h in hits), reverse=True)
    assert {h.doc_id for h in by_query[10]} == {1, 2, 5}
    assert {h.doc_id: h.title for h in by_query[10]}[2] is None
    body = plain_bm25(5.0, 0.2)
    hot = next(h for h in by_query[11] if h.doc_id == 4)
    assert hot.score == pytest.approx(0.7 * body[11, 4] + 0.15 * 0.5 + 0.15 * 3, abs=2e-4)


def test_requested_values(spark):
    wanted = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (1, 2, 7)], "request_id INT, pos INT, doc_id BIGINT")
    table = spark.createDataFrame([(5, 0.5), (7, 0.0)], "doc_id BIGINT, pr DOUBLE")
    aligned = fuse.lookup_values(wanted, table, "pr")
    assert rows(aligned, "pos", "doc_id", "pr") == {(0, 5, 0.5), (1, 6, None), (2, 7, 0.0)}
    assert rows(fuse.lookup_values(wanted, table, "pr", aligned=False), "pos", "pr") == {(0, 0.5)}
    assert rows(fuse.lookup_values(wanted, table, "pr", default=0.0), "pos", "pr") == {(0, 0.5), (1, 0.0), (2, 0.0)}


# Evaluation


def plain_metrics(true, predicted, k=40):
    def hits(upto):
        return len(set(predicted[:upto]) & set(true))

    seen, precisions = 0, []
    for i, d in enumerate(predicted[:k], 1):
        if d in true:
            seen += 1
            precisions.append(seen / i)
    recall, precision = round(hits(100) / len(true), 3), round(hits(100) / 100, 3)
    return {
        "recall_at_k": round(hits(k) / len(true), 3),
        "precision_at_k": round(hits(k) / k, 3),
        "f_score": 2 * recall * precision / (recall + precision) if recall + precision else 0.0,
        "r_precision": round(hits(len(true)) / len(true), 3),
        "avg_precision": round(sum(precisions) / len(precisions), 3) if precisions else 0.0,
        "avg_precision_flat": round(hits(40) / 40, 3) if precisions else 0.0,
    }


def test_metrics(spark):
    predicted = {1: [5, 3, 8, 1, 9, 2], 2: list(range(100, 260)), 3: [], 4: [7]}
    true = {1: [3, 1, 77], 2: [101, 105, 139, 150, 199, 230, 1000], 3: [4], 4: [8]}
    results = spark.createDataFrame(
        [(q, d, i) for q, ds in predicted.items() for i, d in enumerate(ds, 1)], "query_id INT, doc_id INT, rank INT"
    )
    # Judgments may repeat; they are sets.
    qrels = spark.createDataFrame([(q, d) for q, ds in true.items() for d in ds] * 2, "query_id INT, doc_id INT")
    scored = E.evaluate(results, qrels)
    got = {r.query_id: r.asDict() for r in scored.collect()}
    assert set(got) == set(true)
    for q in true:
        for name, value in plain_metrics(true[q], predicted[q]).items():
            assert got[q][name] == pytest.approx(value, abs=1e-9), (q, name)
    at_10 = {r.query_id: r.asDict() for r in E.evaluate(results, qrels, k=10).collect()}
    for q in true:
        for name, value in plain_metrics(true[q], predicted[q], 10).items():
            assert at_10[q][name] == pytest.approx(value, abs=1e-9), (q, name)
    means = E.mean_metrics(scored).first()
    assert means.recall_at_k == pytest.approx(sum(got[q]["recall_at_k"] for q in true) / len(true))


def test_rounding_is_that_of_exact_decimals(spark):
    from corpusq.functions.weights import round_exact

    ratios = [(a / b,) for b in range(1, 201) for a in range(b + 1)]
    df = spark.createDataFrame(ratios, "x DOUBLE")
    wrong = [(x, y) for x, y in df.select("x", round_exact(F.col("x"), 3)).collect() if y != round(x, 3)]
    assert wrong == []


def test_batch_evaluation(spark, index, queries):
    qrels = spark.createDataFrame([(10, 2), (13, 1)], "query_id BIGINT, doc_id BIGINT")
    scored = S.batch_evaluation(rank.bm25(index, queries), qrels, queries)
    assert rows(scored, "query_id", "text", "avg_precision") == {(10, "tea", 1.0), (13, "zzz unknown", 0.0)}


# Page statistics


def plain_pagerank(edges, steps, damping=0.85):
    nodes = sorted({n for e in edges for n in e})
    out = Counter(s for s, _ in edges)
    pr = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(steps):
        idle = sum(pr[n] for n in nodes if not out[n])
        got = Counter()
        for s, d in edges:
            got[d] += pr[s] / out[s]
        pr = {n: (1 - damping) / len(nodes) + damping * (got[n] + idle / len(nodes)) for n in nodes}
    return pr


@pytest.mark.parametrize("links_per_slot", [100_000, 2])
def test_pagerank(spark, links_per_slot):
    edges = {(i % 7, (i * i + 3) % 11) for i in range(60)} | {(0, n) for n in range(11)}
    links = spark.createDataFrame(list(edges) * 2, "src BIGINT, dst BIGINT")
    got = dict(graph.pagerank(links, steps=7, links_per_slot=links_per_slot).collect())
    want = plain_pagerank(edges, 7)
    assert got.keys() == want.keys()
    assert all(got[n] == pytest.approx(want[n], abs=1e-12) for n in want)
    assert sum(got.values()) == pytest.approx(1)


@pytest.mark.parametrize("links_per_slot", [100_000, 2])
def test_converged_pagerank_of_odd_graphs(spark, links_per_slot):
    """A ring (rests do not even out), chains, a page linked to itself, pages without links or without an id."""
    edges = {(i, (i + 1) % 6) for i in range(6)} | {(0, 20), (20, 21), (21, 21), (21, 30), (40, 0), (40, 41)}
    links = spark.createDataFrame([*edges, *edges, (None, 3)], "src BIGINT, dst BIGINT")
    got = dict(graph.pagerank_to_tolerance(links, 1e-10, links_per_slot=links_per_slot).collect())
    want = plain_pagerank(edges, 300)
    # The page without an id gets what every page gets and sends nothing; the others keep their proportions.
    assert got.keys() == want.keys() | {None}
    share = 1 - got.pop(None)
    assert all(got[n] / share == pytest.approx(want[n], abs=1e-9) for n in want)


def test_converged_pagerank_writes_its_ranks_a_few_times(spark, monkeypatch):
    """Was 60 writes of two rounds each."""
    edges = {(i, (i * k + 7 * k) % 40) for i in range(40) for k in range(1, 9)}
    written = []
    monkeypatch.setattr(graph, "materialize", lambda df, name, make=graph.materialize: written.append(name) or make(df, name))
    got = dict(graph.pagerank_to_tolerance(spark.createDataFrame(list(edges), "src BIGINT, dst BIGINT"), 1e-8).collect())
    want = plain_pagerank(edges, 300)
    assert sum(abs(got[n] - want[n]) for n in want) < 1e-8
    assert written.count("ranks") <= 20


def test_pagerank_of_no_links(spark):
    assert graph.pagerank_to_tolerance(spark.createDataFrame([], "src BIGINT, dst BIGINT")).count() == 0
    assert graph.pagerank(spark.createDataFrame([], "src BIGINT, dst BIGINT")).count() == 0


def test_page_views(spark):
    views = spark.createDataFrame(
        [(1, "2021-08-01"), (1, "2021-08-31"), (1, "2021-09-01"), (2, "2021-08-05")], "doc_id BIGINT, day STRING"
    ).select("doc_id", F.to_timestamp("day").alias("ts"))
    monthly = graph.monthly_page_views(views)
    assert rows(monthly.select("doc_id", F.date_format("month", "yyyy-MM"), "views"), "*") == {
        (1, "2021-08", 2), (1, "2021-09", 1), (2, "2021-08", 1),
    }
    assert rows(graph.total_page_views(monthly), "doc_id", "views") == {(1, 3), (2, 1)}


# Judgments


def test_documents_of_all_terms_read_the_terms_of_whole_queries_only(spark, index, queries, monkeypatch):
    """Queries with unknown terms are not looked up, and other terms only beside the rarest."""
    seen = []
    monkeypatch.setattr(match, "deal_out", lambda df, *rest, make=match.deal_out: seen.append(df.count()) or make(df, *rest))
    more = queries.union(spark.createDataFrame([(15, "hot water"), (15, "leaves"), (16, "tea black"), (None, "tea")], queries.schema))
    terms = [(q, t) for q, words in [*ASKED.items(), (15, ["hot", "water", "leaves"]), (16, ["tea", "black"])] for t in set(words)]
    wanted = {(q, d) for q in {q for q, _ in terms} for d in KEPT if all(t in KEPT[d] for p, t in terms if p == q)}
    for small in (True, False):
        if not small:
            monkeypatch.setattr(match, "fits_broadcast", lambda df, *_: False)
        assert rows(match.holding_all_terms(index, more, "body"), "query_id", "doc_id") == wanted
    # tea: 2; green, water: 2 of the one document with green; hot, water, leaves: 3 of the one with leaves; tea, black: 2 of the one with black.
    assert seen[0] == 2 + 2 + 3 + 2 < seen[1]


# Sources


def test_judgments_from_one_map_and_from_lines(spark, tmp_path):
    single = tmp_path / "single.json"
    single.write_text('{"best tea": [1, 2],\n "hot \\"milk\\"": [3]}')
    want = {("best tea", 1), ("best tea", 2), ('hot "milk"', 3)}
    read = T.read_qrels(spark, str(single), multiline=True)
    assert rows(read, "query_text", "doc_id") == want
    T.write_qrels(read, str(tmp_path / "lines"))
    assert rows(T.read_qrels(spark, str(tmp_path / "lines")), "query_text", "doc_id") == want


def test_malformed_input_fails(spark, tmp_path):
    pretty = tmp_path / "pretty.json"
    pretty.write_text('{"best tea": [1, 2],\n "hot milk": [3]}')
    csv = tmp_path / "pr.csv"
    csv.write_text("1,0.5\nx,0.1\n")
    for read in (T.read_qrels(spark, str(pretty)), T.read_token_lists(spark, str(pretty)), T.read_pagerank(spark, str(csv))):
        with pytest.raises(Exception):
            read.collect()
    blank = tmp_path / "blank.json"
    blank.write_text('{"a b": [1]}\n\n')
    assert rows(T.read_qrels(spark, str(blank)), "query_text", "doc_id") == {("a b", 1)}


def test_pagerank_csv(spark, tmp_path):
    table = spark.createDataFrame([(1, 0.1 + 0.2), (2, 1e-17)], "doc_id BIGINT, pr DOUBLE")
    T.write_pagerank(table, str(tmp_path / "pr"))
    assert rows(T.read_pagerank(spark, str(tmp_path / "pr")), "doc_id", "pr") == {(1, 0.1 + 0.2), (2, 1e-17)}


def test_selected_documents_and_anchors(spark):
    corpus = spark.createDataFrame(
        [(1, "a", [(7, "x"), (8, "y")]), (2, "b", []), (3, "c", None)],
        "doc_id BIGINT, title STRING, anchors ARRAY<STRUCT<target_id: BIGINT, text: STRING>>",
    )
    ids = spark.createDataFrame([(1,), (1,), (9,)], "doc_id BIGINT")
    assert rows(C.select_documents(corpus, ids), "doc_id") == {(1,)}
    links = C.project_anchors(corpus)
    assert rows(links, "doc_id", "target_id", "text") == {(1, 7, "x"), (1, 8, "y")}
    assert rows(T.load_table(spark, T.save_anchors(links)), "*") == rows(links, "*")
    unpivoted = C.unpivot_fields(corpus, ["title"])
    assert rows(unpivoted, "doc_id", "field", "text") == {(1, "title", "a"), (2, "title", "b"), (3, "title", "c")}
