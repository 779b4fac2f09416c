"""Generations of an index: safe rebuilds, appends with link texts, compaction, stored word tables, bounds."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from corpusq.operators import index as ix
from corpusq.operators import match, rank
from corpusq.operators import postings as P
from corpusq.sources.storage import names_in

DOCS = [
    (1, "green tea", "green tea leaves and hot water"),
    (2, "black tea", "black tea is tea"),
    (3, "the", "the and of"),
    (70_000, "coffee", "hot coffee hot milk"),
]
LINKS = [(1, "tea tea"), (1, "green tea"), (9, "tea"), (2, "tea cup"), (2, "cup")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id BIGINT, title STRING, body STRING").cache()


@pytest.fixture(scope="module")
def links(spark):
    return spark.createDataFrame(LINKS, "target_id BIGINT, text STRING").cache()


@pytest.fixture()
def path(tmp_path):
    return f"{tmp_path}/index-{uuid.uuid4().hex}"


def content(index):
    return {
        "postings": sorted((tuple(r) for r in index.postings.select("field", "term", "doc_id", "tf", "dl").collect()), key=str),
        "stats": sorted(index.term_stats.select("field", "term", "df", "cf").collect()),
        "len": sorted(index.doc_len.collect()),
        "totals": (index.n, index.total_len, index.fields, index.analysis, index.words.fingerprint),
    }


def test_a_failed_rebuild_leaves_the_old_index(spark, docs, path):
    index = ix.write_index(docs, path, ["body"], num_buckets=2)
    before = content(index)
    broken = docs.withColumn("body", F.when(F.col("doc_id") == 3, F.raise_error(F.lit("no text"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="no text"):
        ix.write_index(broken, path, ["body"], num_buckets=3)
    assert content(ix.open_index(spark, path)) == before == content(index)
    again = ix.write_index(docs.where("doc_id < 3"), path, ["body"], num_buckets=3)
    assert again.n == 2 and content(ix.open_index(spark, path)) == content(again)
    # Who had opened the index before can go on reading it; the build after that removes it.
    assert content(index) == before
    ix.write_index(docs, path, ["body"], num_buckets=2)
    assert sorted(names_in(spark, f"{path}/postings")).count("batch=0") == 0


def test_repeated_ids_are_refused_and_leave_nothing(spark, docs, path):
    twice = docs.unionByName(docs.where("doc_id = 2"))
    with pytest.raises(ValueError, match="twice"):
        ix.write_index(twice, path, ["body"], num_buckets=2)
    assert names_in(spark, f"{path}/doc_terms") == []
    base = ix.write_index(docs.where("doc_id < 3"), path, ["body"], num_buckets=2)
    with pytest.raises(ValueError, match="twice"):
        ix.append_documents(base, twice.where("doc_id >= 3").unionByName(docs.where("doc_id = 3")))
    with pytest.raises(ValueError, match="already has"):
        ix.append_documents(base, docs.where("doc_id >= 2"))
    assert [n for n in names_in(spark, f"{path}/doc_terms") if n.startswith("batch=")] == ["batch=0"]


def test_append_with_link_texts_equals_build(spark, docs, links, path):
    whole = ix.write_index(docs, path + "-whole", ["title", "body"], anchors=links, num_buckets=4)
    first = links.where("text <> 'green tea' and text <> 'cup'")
    base = ix.write_index(docs.where("doc_id < 3"), path, ["title", "body"], anchors=first, num_buckets=4)
    more = links.where("text = 'green tea' or text = 'cup'")
    grown = ix.append_documents(base, docs.where("doc_id >= 3"), anchors=more)
    assert content(grown) == content(whole)
    # Page 1 had "tea" before, so the batch adds an occurrence and no document.
    added = spark.read.parquet(f"{path}/term_stats/batch=1/field=anchor").where("term = 'tea'").first()
    assert (added.df, added.cf) == (0, 1)
    asked = spark.createDataFrame([(1, "tea cup")], "query_id INT, text STRING")
    for found in (rank.tfidf, rank.bm25):
        assert found(grown, asked, "anchor").collect() == found(whole, asked, "anchor").collect()
    with pytest.raises(ValueError, match="no link texts"):
        ix.append_documents(ix.write_index(docs, path + "-bare", ["body"], num_buckets=2), docs.limit(0), anchors=links)


def test_links_and_documents_grow_apart(spark, docs, links, path):
    base = ix.write_index(docs, path, ["body"], anchors=links.limit(0), num_buckets=4)
    grown = ix.append_documents(base, docs.limit(0), anchors=links)
    grown = ix.append_documents(grown, docs.limit(0))
    assert content(grown) == content(ix.write_index(docs, path + "-whole", ["body"], anchors=links, num_buckets=4))


def test_link_texts_have_the_length_of_their_page(spark, docs, links, path):
    index = ix.write_index(docs, path, ["body"], anchors=links, num_buckets=2)
    asked = spark.createDataFrame([(1, "tea")], "query_id INT, text STRING")
    found = {r.doc_id: r.score for r in rank.tfidf(index, asked, "anchor").collect()}
    assert found.keys() == {1, 2, 9} and found[9] == 0.0


def test_an_append_writes_what_its_batch_holds(spark, path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.col("id") % 700, F.lit(" and common")).alias("body"))
    base = ix.write_index(docs.where("doc_id < 1990"), path, ["body"], num_buckets=2)
    ix.append_documents(base, docs.where("doc_id >= 1990"))
    rows = {t: spark.read.parquet(f"{path}/{t}/batch=1").count() for t in ("postings", "term_stats", "doc_terms")}
    assert rows == {"postings": 20, "term_stats": 11, "doc_terms": 10}


def test_compaction(spark, docs, links, path):
    index = ix.write_index(docs.where("doc_id = 1"), path, ["body"], anchors=links.limit(1), min_df=1, num_buckets=2)
    index = ix.append_documents(index, docs.where("doc_id in (2, 3)"), anchors=links.where("target_id = 2"))
    index = ix.append_documents(index, docs.where("doc_id > 3"))
    before = content(index)
    small = ix.compact_index(index)
    assert content(small) == before == content(index) and len(small.parts) == 1
    with pytest.raises(ValueError, match="grown since"):
        ix.compact_index(index)
    ix.clean_index(spark, path)
    assert {n for n in names_in(spark, f"{path}/postings") if n[0] != "_" and n[0] != "."} == {f"batch={small.gen}"}
    assert content(ix.open_index(spark, path)) == before
    assert content(ix.append_documents(small, docs.limit(0))) == before


def test_word_tables_stay_with_the_index(spark, docs, path):
    forms = [("walked", "walk"), ("walks", "walk"), ("leaves", "leaf")]
    lemmas = spark.createDataFrame(forms, "form STRING, lemma STRING")
    texts = spark.createDataFrame([(1, "she walks green"), (2, "he walked black")], "doc_id BIGINT, body STRING")
    index = ix.write_index(texts, path, ["body"], stop=["she", "black"], lemmas=lemmas, num_buckets=2)
    asked = spark.createDataFrame([(7, "walk"), (8, "walked she")], "query_id BIGINT, text STRING")
    for opened in (index, ix.open_index(spark, path), ix.compact_index(index)):
        for found in (rank.bm25(opened, asked), rank.tfidf(opened, asked), rank.term_match(opened, asked, "body"), match.candidates(opened, asked, "body")):
            assert {(r.query_id, r.doc_id) for r in found.collect()} == {(7, 1), (7, 2), (8, 1), (8, 2)}
    opened = ix.open_index(spark, path)
    with pytest.raises(ValueError, match="other stop words"):
        ix.append_documents(opened, texts.withColumn("doc_id", F.col("doc_id") + 5), stop=["she"])
    with pytest.raises(ValueError, match="other stop words"):
        ix.append_documents(opened, texts.withColumn("doc_id", F.col("doc_id") + 5), lemmas=lemmas.limit(2))
    again = spark.createDataFrame(forms[::-1] + forms[:1], "form STRING, lemma STRING")
    grown = ix.append_documents(opened, texts.withColumn("doc_id", F.col("doc_id") + 5), stop=["black", "she"], lemmas=again)
    assert {r.doc_id for r in grown.posting_list("walk", "body").collect()} == {1, 2, 6, 7}


def test_long_stop_tables_are_stored(spark, docs, path, monkeypatch):
    monkeypatch.setattr(P.stop_parts, "__defaults__", (3,))
    table = spark.createDataFrame([(w,) for w in ["tea", "and", "is", "the", "of"]], "term STRING")
    index = ix.write_index(docs, path, ["body"], stop=table, num_buckets=2)
    assert "tea" not in {r.term for r in ix.open_index(spark, path).term_stats.collect()}
    asked = spark.createDataFrame([(1, "tea hot")], "query_id INT, text STRING")
    assert [tuple(r) for r in match.terms_for(ix.open_index(spark, path), asked).rows.collect()] == [(1, "hot", 1, 1)]
    assert index.words.stop_batch == 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """3,000 documents in two batches: three in ten are copies, one term is everywhere, ids leave gaps."""
    rng = random.Random(5)
    rows = []
    for k in range(3000):
        words = [f"word{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randint(0, 30))]
        rows.append((k * k, "copy one two three" if rng.random() < 0.3 else " ".join(["everywhere", *words])))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, body STRING")
    path = str(tmp_path_factory.mktemp("skewed") / "index")
    base = ix.write_index(docs.where("doc_id < 4000000"), path, ["body"], stop=[], num_buckets=4)
    return ix.append_documents(base, docs.where("doc_id >= 4000000"))


@pytest.fixture(scope="module")
def asked(spark):
    rng = random.Random(6)
    texts = ["everywhere", "copy", "unknown", "everywhere copy word399", *(" ".join(f"word{rng.choice([2, 20, 30, 40, 60, 90])}" for _ in range(4)) + " everywhere" for _ in range(12))]
    return spark.createDataFrame(list(enumerate(texts)), "query_id INT, text STRING")


@pytest.mark.parametrize("n", [1, 10, 5000])
@pytest.mark.parametrize("params", [rank.Bm25(), rank.Bm25(5.0, 0.2), rank.Bm25(0.5, 1.0)])
def test_pruned_ranks_are_the_full_ones(skewed, asked, n, params):
    full = rank.bm25(skewed, asked, "body", params, n, prune=False)
    assert sorted(map(tuple, rank.bm25(skewed, asked, "body", params, n, prune=True).collect())) == sorted(map(tuple, full.collect()))


def test_pruning_halves_the_rows_to_be_added_up(skewed, asked):
    """Of queries with rare terms; those of dense terms only have no threshold."""
    terms = match.terms_for(skewed, asked.where("query_id > 3"))
    known = match.known_terms(skewed, terms, "body").select("query_id", "term", "df")
    every = match.matches(skewed, known, terms, "body").count()
    assert rank.bounded_parts(skewed, terms, "body", rank.Bm25(5.0, 0.2), 10).count() * 2 < every


def test_pruning_without_broadcasts(skewed, asked, monkeypatch):
    from corpusq.operators import joins

    want = sorted(map(tuple, rank.bm25(skewed, asked, n=10).collect()))
    for module in (joins, rank, match):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(match, "FETCH_ROWS", 3)
    assert sorted(map(tuple, rank.bm25(skewed, asked, n=10, prune=True).collect())) == want
