"""Layouts beside the index: postings by document, lists of equal blocks, norms that follow appends."""

import re

import pytest
from pyspark.sql import functions as F

from corpusq.operators import graph
from corpusq.operators import index as ix
from corpusq.operators import joins
from corpusq.operators import norms as N
from corpusq.operators import postings as P
from corpusq.operators import rank
from corpusq.registry import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """An index before and after an append, and one built from all documents."""
    docs, path = fx.documents(spark, SF), str(tmp_path_factory.mktemp("layouts"))
    before = ix.write_index(docs.where("not lang <=> 'de'"), f"{path}/grown", ["body"], num_buckets=4)
    after = ix.append_documents(before, docs.where("lang <=> 'de'"))
    return before, after, ix.write_index(docs, f"{path}/whole", ["body"], num_buckets=4)


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


def test_scores_by_document_need_no_shuffle_of_matches(spark, grown):
    _, index, _ = grown
    assert ix.postings_by_document(index, "body") is None
    ix.lay_out_by_document(index, "body", segments=6)
    copy = ix.postings_by_document(index, "body")
    columns = ["field", "bucket", "term", "doc_id", "tf", "dl"]
    assert sorted(copy.select(columns).collect()) == sorted(index.all_postings.select(columns).collect())
    queries = fx.queries(spark, SF)
    plain, near = rank.bm25_scores(index, queries), rank.bm25_scores(index, queries, postings=copy)
    assert re.search(r"Exchange hashpartitioning\(query_id", plan_of(plain))
    assert not re.search(r"Exchange (hash|range|round)", plan_of(near).split("BroadcastExchange")[0])
    assert "hashpartitioning(query_id" not in plan_of(near) and "Bucketed: true" in plan_of(near)
    assert sorted(near.collect()) == sorted(plain.collect())
    # Another session's catalog need not know the copy, and a new generation has none.
    assert spark.catalog.listTables() == []
    assert ix.postings_by_document(ix.append_documents(index, fx.documents(spark, SF).limit(0)), "body") is None


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_lists_are_cut_by_count(spark, grown, size):
    rows = grown[2].all_postings.withColumn("doc_id", F.xxhash64("doc_id"))
    lists = P.equal_posting_lists(rows, size).collect()
    want, got = {}, {}
    for r in rows.collect():
        want.setdefault(r.term, []).append((r.doc_id, r.tf))
    for r in sorted(lists, key=lambda r: (r.term, r.block)):
        got.setdefault(r.term, []).append([tuple(p) for p in r.postings])
    assert {t: [p for block in blocks for p in block] for t, blocks in got.items()} == {t: sorted(ps) for t, ps in want.items()}
    for blocks in got.values():
        total = sum(map(len, blocks))
        assert len(blocks) == -(-total // size)
        assert max(map(len, blocks)) <= size and max(map(len, blocks)) - min(map(len, blocks)) <= 1


def test_norms_after_an_append_are_those_of_a_rebuild(grown):
    before, after, whole = grown
    found = N.norms_of(N.norm_sums_after_append(N.norm_sums(before), before, after), after.n)
    want = {r.doc_id: r for r in P.document_norms(whole.postings, whole.term_stats, whole.n).collect()}
    got = {r.doc_id: r for r in found.collect()}
    assert got.keys() == want.keys()
    for doc, r in got.items():
        assert r.norm == pytest.approx(want[doc].norm, rel=1e-9) and r.weight_norm == pytest.approx(want[doc].weight_norm, rel=1e-7)
    with pytest.raises(ValueError, match="batches added"):
        N.norm_sums_after_append(N.norm_sums(before), after, before)


def test_norms_of_documents_without_rare_terms(spark, tmp_path):
    docs = spark.createDataFrame([(1, "tea tea"), (2, "tea"), (3, "tea")], "doc_id BIGINT, body STRING")
    index = ix.write_index(docs, str(tmp_path / "tea"), ["body"], num_buckets=1)
    want = {r.doc_id: r for r in P.document_norms(index.postings, index.term_stats, index.n).collect()}
    for r in N.norms_of(N.norm_sums(index), index.n).collect():
        assert r.norm == want[r.doc_id].norm == 0.0
        assert r.weight_norm == pytest.approx(want[r.doc_id].weight_norm, rel=1e-6)


def test_norms_look_up_repeated_terms_only(spark, tmp_path, monkeypatch):
    """Terms of one document are too many to broadcast, the others are not: postings stay where they are."""
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, limit=50: df.limit(limit + 1).count() <= limit)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 50)
    words = [" ".join([f"own{i}x{k}" for k in range(20)] + ["tea"] * (i % 3 + 1) + ["hot"] * (i % 2)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id BIGINT, body STRING")
    index = ix.write_index(docs, str(tmp_path / "own"), ["body"], num_buckets=2)
    want = {r.doc_id: r for r in P.document_norms(index.postings, index.term_stats, index.n).collect()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = N.norm_sums(index)
        assert "SortMergeJoin" not in plan_of(sums) and plan_of(sums).count("Exchange hashpartitioning") == 1
        got = {r.doc_id: r for r in N.norms_of(sums, index.n).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got.keys() == want.keys()
    assert all(r.norm == pytest.approx(want[d].norm, rel=1e-9) for d, r in got.items())


@pytest.mark.parametrize("limit", [0, 20, 300])
def test_norms_with_more_repeated_terms_than_can_be_broadcast(grown, monkeypatch, limit):
    before, after, whole = grown
    want = {r.doc_id: r.norm for r in P.document_norms(whole.postings, whole.term_stats, whole.n).collect()}
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    assert whole.term_stats.where("df > 1").count() > limit
    for sums in (N.norm_sums(whole), N.norm_sums_after_append(N.norm_sums(before), before, after)):
        got = {r.doc_id: r.norm for r in N.norms_of(sums, whole.n).collect()}
        assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-9) for d in want)


def test_norms_of_lemmas_and_link_texts(spark, tmp_path):
    docs = spark.createDataFrame([(1, "teas tea hot"), (2, "teas"), (3, "hot milk"), (4, None)], "doc_id BIGINT, body STRING")
    links = spark.createDataFrame([(1, "hot tea"), (2, "hot"), (9, "tea tea")], "target_id BIGINT, text STRING")
    lemmas = spark.createDataFrame([("teas", "tea")], "form STRING, lemma STRING")
    index = ix.write_index(docs, str(tmp_path / "lemmas"), ["body"], anchors=links, lemmas=lemmas, num_buckets=2)
    for field in ("body", "anchor"):
        rows, stats = (t.where(F.col("field") == field) for t in (index.postings, index.term_stats))
        want = {r.doc_id: r.norm for r in P.document_norms(rows, stats, index.n).collect()}
        got = {r.doc_id: r.norm for r in N.norms_of(N.norm_sums(index, field), index.n).collect()}
        assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-9) for d in want)


def test_lookups_of_hot_ids_are_not_shuffled(spark, monkeypatch):
    """Without adaptive execution: most requests are for one id, some for none."""
    rows = spark.range(5000).select(F.col("id").alias("pos"), F.when(F.col("id") % 10 < 8, 7).when(F.col("id") % 10 == 8, F.col("id")).alias("doc_id"))
    table = spark.range(0, 5000, 7).select(F.col("id").alias("doc_id"), (F.col("id") * 2).alias("v"))
    other = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("w"))
    want = sorted(joins.lookup(rows, "doc_id", table, other).collect(), key=str)
    monkeypatch.setattr(joins, "HOT_LOOKUPS", 100)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: df.columns == ["doc_id"] and df.count() < 10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.lookup(rows, "doc_id", table, other)
        assert sorted(found.collect(), key=str) == want
        sizes = found.where("v is null or doc_id <> 7").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_pagerank_to_a_tolerance(spark):
    """A chain, a hub, a cycle, pages without links and repeated links, against many plain steps."""
    edges = [(k, k + 1) for k in range(6)] + [(k, 50) for k in range(20, 40)] + [(50, 20), (50, 51), (60, 61), (61, 60), (61, 60), (70, 70)]
    links = spark.createDataFrame(edges, "src BIGINT, dst BIGINT")
    known, out = sorted({x for e in edges for x in e}), {}
    for a, b in set(edges):
        out.setdefault(a, []).append(b)
    rank = dict.fromkeys(known, 1 / len(known))
    for _ in range(300):
        idle = sum(r for d, r in rank.items() if d not in out)
        new = dict.fromkeys(known, (0.15 + 0.85 * idle) / len(known))
        for a, ends in out.items():
            for b in ends:
                new[b] += 0.85 * rank[a] / len(ends)
        rank = new
    for tolerance in (1e-3, 1e-6):
        got = dict(graph.pagerank_to_tolerance(links, tolerance, links_per_slot=1).collect())
        assert got.keys() == rank.keys() and sum(abs(got[d] - rank[d]) for d in known) < tolerance
    assert graph.pagerank_to_tolerance(links.limit(0)).count() == 0


def scanned_rows(df):
    """Rows that the scans of a query without exchanges handed on, all row groups that they read."""
    df._jdf.collectToPython()
    todo, found = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        children = plan.children()
        todo += [children.apply(i) for i in range(children.size())]
        if children.size() == 0:
            found += plan.metrics().apply("numOutputRows").value()
    return found


def test_thousands_of_terms_read_few_row_groups(spark, tmp_path, monkeypatch):
    """Bloom filters of the row groups: most hold none of the terms, though these span all of the alphabet."""
    docs = fx.documents(spark, SF).withColumn(
        "body",
        F.concat_ws(" ", "body", F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: F.concat(F.lit("w"), F.md5(F.concat_ws("-", "doc_id", i)).substr(1, 12)))),
    )
    monkeypatch.setattr(ix, "ROW_GROUP_BYTES", 16 * 1024)
    index = ix.write_index(docs, str(tmp_path / "rows"), ["body"], num_buckets=2)
    terms = [r.term for r in index.term_stats.where("df = 1").orderBy(F.xxhash64("term")).limit(20).select("term").collect()]
    batch = terms + [f"w{i:x}-absent" for i in range(3_771)] + ["it's\\", "\"quoted\"", "日本"]
    found = index.of_terms(index.all_postings, batch)
    assert sorted(r.term for r in found.collect()) == sorted(terms)
    assert 0 < scanned_rows(found) < index.all_postings.count() / 2
    # The same rows as by a join, which literals replace for batches of up to LITERAL_TERMS terms.
    joined = index.all_postings.join(spark.createDataFrame([(t,) for t in batch], "term STRING"), "term", "left_semi")
    assert sorted(found.select("term", "doc_id", "tf").collect()) == sorted(joined.select("term", "doc_id", "tf").collect())
    assert index.of_terms(index.all_postings, []).count() == 0


def test_files_by_document_hold_what_a_task_can_sort():
    """A posting takes about 100 bytes while it is sorted; four tasks share an executor."""
    assert ix.SEGMENT_ROWS * 100 <= 500e6
