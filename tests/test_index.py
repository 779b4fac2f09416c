"""The stored index: round trip, append, rebuild, lookups, statistics, plans."""

import uuid

import pytest
from pyspark.sql import functions as F

from corpusq.functions.text import term_bucket_of
from corpusq.operators import index as ix
from corpusq.operators import joins, match, rank
from corpusq.operators import postings as P
from corpusq.operators.numbering import number_values
from corpusq.registry import fixtures as fx

SF = "/root/testdata/sf0.001"

DOCS = [
    (1, "green tea", "green tea leaves and hot water"),
    (2, "black tea", "black tea is tea"),
    (3, "the", "the and of"),
    (70_000, "coffee", "hot coffee hot milk"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id BIGINT, title STRING, body STRING")


@pytest.fixture()
def path(tmp_path):
    return f"{tmp_path}/index-{uuid.uuid4().hex}"


def plan_of(df):
    # Formatted, because the plain form cuts long lists of filters short.
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def content(index):
    return {
        "postings": sorted(index.postings.select("field", "term", "doc_id", "tf", "dl").collect()),
        "stats": sorted(index.term_stats.select("field", "term", "df", "cf").collect()),
        "len": sorted(index.doc_len.collect()),
        "totals": (index.n, index.total_len),
    }


def test_round_trip(spark, docs, path):
    index = ix.write_index(docs, path, ["title", "body"], num_buckets=4)
    assert (index.n, index.total_len, index.num_buckets, index.gen) == (4, 12, 4, 0)
    assert index.avg_dl == 3.0
    assert {tuple(r) for r in index.doc_len.collect()} == {(1, 5), (2, 3), (3, 0), (70_000, 4)}
    again = ix.open_index(spark, path)
    assert content(again) == content(index)
    tea = again.term_stats.where("field = 'body' AND term = 'tea'").select("df", "cf").first()
    assert tuple(tea) == (2, 3)
    assert [tuple(r) for r in again.posting_list("hot", "body").collect()] == [(1, 1), (70_000, 2)]
    assert again.posting_list("unknown", "body").collect() == []


def test_invariants_on_documents(spark):
    index = fx.documents_index(spark, SF)
    tf = index.postings.agg(F.sum("tf")).first()[0]
    dl = index.doc_len.agg(F.sum("dl")).first()[0]
    kept = P.kept_token_rows(fx.documents(spark, SF), "body").count()
    assert tf == dl == kept == index.total_len
    stats = index.term_stats.agg(F.sum("df"), F.sum("cf")).first()
    assert tuple(stats) == (index.postings.count(), tf)
    assert index.n == fx.documents(spark, SF).count()


def test_append_equals_build(spark, docs, path):
    base = ix.write_index(docs.where("doc_id < 3"), path, ["body"], num_buckets=4)
    grown = ix.append_documents(base, docs.where("doc_id >= 3"))
    whole = ix.write_index(docs, path + "-whole", ["body"], num_buckets=4)
    assert content(grown) == content(whole)
    assert grown.gen == 1


def test_uncommitted_batch_is_invisible_and_replaced(spark, docs, path):
    base = ix.write_index(docs.where("doc_id < 3"), path, ["body"], num_buckets=4)
    before = content(base)
    # A batch whose write stopped before the commit.
    extra = docs.where("doc_id >= 3")
    terms = ix._write_doc_terms(P.document_terms(extra, ["body"]), path, 1)
    ix._Batch(spark, path, 1, 4).write_postings("body", P.postings_of(terms, ["body"]))
    assert content(ix.open_index(spark, path)) == before
    grown = ix.append_documents(ix.open_index(spark, path), extra)
    assert content(grown) == content(ix.write_index(docs, path + "-whole", ["body"], num_buckets=4))


def test_rebuild_and_delete(spark, docs, path):
    ix.write_index(docs, path, ["title", "body"], num_buckets=4)
    second = ix.write_index(docs.where("doc_id = 2"), path, ["body"], num_buckets=2)
    assert {r.term for r in second.term_stats.collect()} == {"black", "tea"}
    ix.delete_index(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ix.open_index(spark, path)


def test_min_df_keeps_terms_above_the_threshold(docs, path):
    index = ix.write_index(docs, path, ["body"], min_df=1, num_buckets=4)
    assert {r.term for r in index.term_stats.collect()} == {"tea", "hot"}
    assert {r.term for r in index.postings.collect()} == {"tea", "hot"}


def test_append_after_min_df_equals_build(spark, docs, path):
    base = ix.write_index(docs.where("doc_id < 3"), path, ["body"], min_df=1, binary_tf=True, num_buckets=4)
    assert {r.term for r in base.term_stats.collect()} == {"tea"}
    grown = ix.append_documents(base, docs.where("doc_id >= 3"))
    whole = ix.write_index(docs, path + "-whole", ["body"], min_df=1, binary_tf=True, num_buckets=4)
    assert content(grown) == content(whole)
    assert [r.doc_id for r in grown.posting_list("hot", "body").collect()] == [1, 70_000]
    assert grown.analysis == ix.Analysis(1, True, None)


def test_append_refuses_known_ids_and_stale_indexes(spark, docs, path):
    base = ix.write_index(docs.where("doc_id < 3"), path, ["body"], num_buckets=4)
    with pytest.raises(ValueError, match="already has"):
        ix.append_documents(base, docs.where("doc_id >= 2"))
    grown = ix.append_documents(base, docs.where("doc_id = 3"))
    with pytest.raises(ValueError, match="grown since"):
        ix.append_documents(base, docs.where("doc_id = 70000"))
    assert grown.n == 3


def test_lemmas_of_queries(spark, docs, path):
    lemmas = spark.createDataFrame([("leaves", "leaf"), ("leafs", "leaf")], "form STRING, lemma STRING")
    index = ix.write_index(docs, path, ["body"], lemmas=lemmas, num_buckets=4)
    asked = spark.createDataFrame([(7, "leafs leaves")], "query_id BIGINT, text STRING")
    terms = match.measured_terms(asked, lemmas=lemmas)
    assert [tuple(r) for r in terms.rows.collect()] == [(7, "leaf", 2, 2)]
    for found in (rank.bm25(index, terms), rank.tfidf(index, terms), rank.term_match(index, terms, "body")):
        assert [r.doc_id for r in found.collect()] == [1]


def test_binary_tf(docs, path):
    index = ix.write_index(docs, path, ["body"], binary_tf=True, num_buckets=4)
    assert {r.tf for r in index.postings.collect()} == {1}
    assert index.total_len == 12


def test_anchor_field(spark, docs, path):
    anchors = spark.createDataFrame([(1, "tea tea"), (1, "green tea"), (9, "tea")], "target_id BIGINT, text STRING")
    index = ix.write_index(docs, path, ["body"], anchors=anchors, num_buckets=4)
    rows = index.postings.where("field = 'anchor'").select("term", "doc_id", "tf").collect()
    assert {tuple(r) for r in rows} == {("tea", 1, 3), ("green", 1, 1), ("tea", 9, 1)}


def test_posting_lists_are_sorted_blocks(docs):
    postings = P.postings_of(P.document_terms(docs, ["body"]), ["body"])
    lists = {(r.term, r.block): [tuple(p) for p in r.postings] for r in P.posting_lists(postings).collect()}
    assert lists[("hot", 0)] == [(1, 1)] and lists[("hot", 1)] == [(70_000, 2)]
    assert lists[("tea", 0)] == [(1, 1), (2, 2)]


def test_norms(spark, docs, path):
    import math

    index = ix.write_index(docs, path, ["body"], num_buckets=4)
    rows = {r.doc_id: r for r in P.document_norms(index.postings, index.term_stats, index.n).collect()}
    # Document 2: black once (df 1), tea twice (df 2), of 4 documents and 3 tokens.
    want = math.sqrt(math.log(4) ** 2 + (2 * math.log(2)) ** 2)
    assert rows[2].norm == pytest.approx(want)
    assert rows[2].weight_norm == pytest.approx(want / 3, rel=1e-6)
    assert 3 not in rows


def test_numbering_is_the_dense_rank(spark):
    words = [w for n in range(300) for w in (f"w{n * 7919 % 1000}",) * (n % 3 + 1)]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "term STRING").repartition(5)
    got = dict(number_values(df, "term", "no").collect())
    assert got == {w: i + 1 for i, w in enumerate(sorted(set(words)))}


def test_salted_join_gives_the_broadcast_rows(spark):
    # One key holds most of the rows.
    large = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).alias("k"))
    small = spark.range(0, 2000, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        fast = joins.sized_join(large, small, ["k"], how, spread="doc_id", small_fits=True)
        plain = joins.sized_join(large, small, ["k"], how, spread="doc_id", small_fits=False)
        assert fast.exceptAll(plain).isEmpty() and plain.exceptAll(fast).isEmpty()
    counted = small.withColumn("n", F.when(F.col("k") == 7, 1800).otherwise(1))
    for how in ("inner", "left", "left_semi", "left_anti"):
        fast = joins.sized_join(large, counted, ["k"], how, spread="doc_id", small_fits=True)
        salted = joins.sized_join(large, counted, ["k"], how, spread="doc_id", small_fits=False, rows="n", rows_per_salt=100)
        assert fast.columns == salted.columns
        assert fast.exceptAll(salted).isEmpty() and salted.exceptAll(fast).isEmpty()


def test_only_hot_keys_are_repeated(spark):
    small = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") == 7, 1000).otherwise(3).alias("n"))
    large = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("k"))
    joined = joins.sized_join(large, small, ["k"], spread="doc_id", small_fits=False, rows="n", rows_per_salt=100)
    assert joined.count() == 50
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / 100))
    assert small.select(F.sum(salts)).first()[0] == 999 + 10


def test_empty_documents_have_weight_zero(spark, tmp_path):
    """Titles of documents without a body, and an index of nothing."""
    docs = spark.createDataFrame([(1, "green tea", ""), (2, "black tea", None)], "doc_id BIGINT, title STRING, body STRING")
    index = ix.write_index(docs, str(tmp_path / "titles"), ["title", "body"], num_buckets=2)
    queries = spark.createDataFrame([(1, "tea green")], "query_id INT, text STRING")
    assert [r.score for r in rank.tfidf(index, queries, "title").collect()] == [0.0, 0.0]
    assert {r.weight_norm for r in P.document_norms(index.postings.where("field = 'title'"), index.term_stats.where("field = 'title'"), 2).collect()} == {0.0}
    assert [r.doc_id for r in rank.bm25(index, queries, "title").collect()] == [1, 2]
    empty = ix.write_index(docs.limit(0), str(tmp_path / "none"), ["body"], num_buckets=2)
    assert empty.corpus_stats().first().avg_dl == 0.0


def test_lookup_without_broadcast_gives_the_same_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 5), (2, 6), (3, 99)], "query_id INT, doc_id BIGINT")
    table = spark.range(10).select(F.col("id").alias("doc_id"), (F.col("id") * 2).alias("v"))
    small = sorted(joins.lookup(rows, "doc_id", table).collect(), key=str)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert sorted(joins.lookup(rows, "doc_id", table).collect(), key=str) == small


def test_long_query_batches_match_like_short_ones(spark, monkeypatch):
    index, queries = fx.documents_index(spark, SF), fx.queries(spark, SF)

    def found():
        terms = match.measured_terms(queries)
        known = match.known_terms(index, terms, "body")
        return terms, known, match.matches(index, known.drop("qlen"), terms, "body")

    want = sorted(found()[2].select("query_id", "term", "doc_id", "tf", "df").collect())
    monkeypatch.setattr(match, "FETCH_ROWS", 3)
    monkeypatch.setattr(match, "fits_broadcast", lambda df: False)
    terms, known, rows = found()
    assert terms.terms is None and not terms.small
    assert "_salt" in plan_of(rows)
    assert sorted(rows.select("query_id", "term", "doc_id", "tf", "df").collect()) == want


def test_term_lookup_prunes_the_scan(spark):
    plan = plan_of(fx.documents_index(spark, SF).posting_list("there", "body"))
    assert "EqualTo(term,there)" in plan
    bucket = term_bucket_of("there", fx.NUM_BUCKETS)
    assert f"= {bucket})" in plan[plan.index("PartitionFilters") :]


def test_few_query_terms_prune_the_scan(spark):
    from corpusq.operators.rank import bm25

    query = spark.createDataFrame([(1, "there onen with")], "query_id BIGINT, text STRING")
    plan = plan_of(bm25(fx.documents_index(spark, SF), query))
    scan = plan[plan.index("/postings") :]
    buckets = sorted({term_bucket_of(t, fx.NUM_BUCKETS) for t in ("onen",)})
    assert f"= {buckets[0]})" in scan[: scan.index("PushedFilters")]
    assert "EqualTo(term,onen)" in scan


def test_ranking_reads_no_text_and_runs_no_python(spark):
    from corpusq.operators.rank import bm25

    plan = plan_of(bm25(fx.documents_index(spark, SF), fx.queries(spark, SF)))
    assert "documents.parquet" not in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_index_build_shuffles_postings_once(spark, docs):
    rows = P.postings_of(P.document_terms(docs, ["body"], is_scan=False), ["body"])
    assert "Exchange" not in plan_of(rows)
    laid_out = rows.withColumn("bucket", F.crc32("term")).hint("rebalance", "bucket")
    assert plan_of(laid_out.sortWithinPartitions("bucket", "term")).count("- Exchange") == 1


def test_files_are_sorted_by_term(spark, path):
    docs = fx.documents(spark, SF)
    ix.write_index(docs, path, ["body"], num_buckets=3)
    import glob

    import pyarrow.parquet as pq

    files = glob.glob(f"{path}/postings/batch=0/field=body/bucket=*/*.parquet")
    assert files
    for file in files:
        table = pq.ParquetFile(file).read(columns=["term", "doc_id"])
        keys = [(t.encode(), d) for t, d in zip(table["term"].to_pylist(), table["doc_id"].to_pylist())]
        assert keys == sorted(keys)
