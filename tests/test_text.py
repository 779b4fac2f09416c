"""Tokens, stop words, term counts, buckets, typed tokens."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from corpusq.functions import typed
from corpusq.functions.text import (
    CORPUS_STOP_WORDS,
    ENGLISH_STOP_WORDS,
    kept_tokens,
    term_bucket,
    term_bucket_of,
    tokens,
)
from corpusq.operators import postings as P

WORD = re.compile(r"[\#\@\w](['\-]?\w){2,24}", re.UNICODE)

TEXTS = [
    "Don't stop",
    "a-b-c and a--bcd",
    "#tag @name #x",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ab abc it's o'clock rock'n'roll",
    "Été à Zürich, naïve café ünïcödé",
    "under_score 3rd 2021 x",
    "'quoted' -dash- end-",
    "日本語 テスト русский текст",
    "",
]


def test_stop_list_sizes():
    assert len(ENGLISH_STOP_WORDS) == len(set(ENGLISH_STOP_WORDS)) == 179
    assert len(CORPUS_STOP_WORDS) == len(set(CORPUS_STOP_WORDS)) == 21


def test_tokens_match_the_definition(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text STRING")
    for text, found in df.select("text", tokens(F.col("text"))).collect():
        assert found == [m.group() for m in WORD.finditer(text.lower())], text


def test_tokens_of_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for text, found in docs.select("text", tokens(F.col("text"))).collect():
        assert found == [m.group() for m in WORD.finditer(text.lower())]


def test_long_runs_are_split_and_short_rests_dropped(spark):
    df = spark.createDataFrame([("x" * 27,), ("x" * 28,)], "text STRING")
    assert [[len(t) for t in r[0]] for r in df.select(tokens(F.col("text"))).collect()] == [[25], [25, 3]]


def test_null_text_has_no_tokens(spark):
    df = spark.createDataFrame([(1, None)], "doc_id BIGINT, body STRING")
    assert df.select(kept_tokens(F.col("body"))).first()[0] == []
    assert P.document_terms(df, ["body"]).collect()[0].asDict() == {"doc_id": 1, "dl": 0, "body": []}
    assert P.postings_of(P.document_terms(df, ["body"]), ["body"]).count() == 0


def test_stop_words_as_table_give_the_same_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnRenamed("text", "body")
    words = ["the", "and", "les", "der"]
    table = spark.createDataFrame([(w,) for w in words], "word STRING")
    want = sorted(P.postings_of(P.document_terms(docs, ["body"], words), ["body"]).collect())
    short = sorted(P.postings_of(P.document_terms(docs, ["body"], table), ["body"]).collect())
    long = sorted(P.postings_of(P.document_terms(docs, ["body"], table, stop_literals=2), ["body"]).collect())
    assert want == short == long


def test_long_stop_tables_and_repeated_ids(spark):
    """Links to one page, and given token lists beside text, whichever way the stop table goes in."""
    table = spark.createDataFrame([("drop",), (None,), ("drop",)], "word STRING")
    links = spark.createDataFrame([(1, "alpha drop"), (1, "alpha"), (1, "alpha beta"), (2, "drop")], "target_id BIGINT, text STRING")
    mixed = spark.createDataFrame([(1, ["zzz1", "drop"], "drop word"), (1, [], "drop"), (2, None, None)], "doc_id BIGINT, given ARRAY<STRING>, body STRING")
    for literals in (0, 10):
        anchors = P.anchor_postings(links, table, stop_literals=literals).collect()
        assert {(r.term, r.doc_id, r.tf) for r in anchors} == {("alpha", 1, 3), ("beta", 1, 1)}
        terms = P.document_terms(mixed, ["given", "body"], table, stop_literals=literals).collect()
        found = sorted((r.doc_id, r.dl, [tuple(t) for t in r.given], [tuple(t) for t in r.body]) for r in terms)
        assert found == [(1, 0, [], []), (1, 1, [("drop", 1), ("zzz1", 1)], [("word", 1)]), (2, 0, [], [])]


def test_dates_take_unicode_blanks_as_typed_tokens_do(spark):
    from corpusq.functions import typed

    df = spark.createDataFrame([("9\u00a0October\u00a02021",)], "text STRING")
    assert df.select(typed.extract_dates(F.col("text"))).first()[0] == ["9\u00a0October\u00a02021"]


def test_term_counts(spark):
    docs = spark.createDataFrame([(1, "tea tea the milk tea"), (2, "the"), (3, "milk sugar")], "doc_id BIGINT, body STRING")
    terms = P.document_terms(docs, ["body"])
    assert {(r.doc_id, r.dl) for r in terms.collect()} == {(1, 4), (2, 0), (3, 2)}
    rows = {(r.term, r.doc_id, r.tf) for r in P.postings_of(terms, ["body"]).collect()}
    assert rows == {("tea", 1, 3), ("milk", 1, 1), ("milk", 3, 1), ("sugar", 3, 1)}


def test_length_field_may_differ_from_the_posted_field(spark):
    docs = spark.createDataFrame([(1, "green tea", "cup water leaves")], "doc_id BIGINT, title STRING, body STRING")
    rows = P.postings_of(P.document_terms(docs, ["title", "body"]), ["title", "body"])
    assert {(r.field, r.term, r.dl) for r in rows.collect()} == {
        ("title", "green", 3), ("title", "tea", 3), ("body", "cup", 3), ("body", "water", 3), ("body", "leaves", 3),
    }


def test_bucket_of_a_literal_equals_the_column(spark):
    words = ["tea", "café", "日本語", "o'clock"]
    df = spark.createDataFrame([(w,) for w in words], "term STRING")
    for term, bucket in df.select("term", term_bucket(F.col("term"), 124)).collect():
        assert bucket == term_bucket_of(term, 124) == zlib.crc32(term.encode()) % 124


def test_lemmas_add_up_forms(spark):
    docs = spark.createDataFrame([(1, "walked walking walks green"), (2, "walked their")], "doc_id BIGINT, body STRING")
    lemmas = spark.createDataFrame(
        [("walked", "walk"), ("walking", "walk"), ("walks", "walk"), ("green", "the")], "form STRING, lemma STRING"
    )
    postings = P.postings_of(P.document_terms(docs, ["body"]), ["body"])
    real = P.lemma_postings(postings, lemmas)
    assert {(r.term, r.doc_id, r.tf) for r in real.collect()} == {("walk", 1, 3), ("walk", 2, 1)}
    once = P.lemma_postings(postings, lemmas, binary_tf=True)
    assert {(r.term, r.doc_id, r.tf) for r in once.collect()} == {("walk", 1, 1), ("walk", 2, 1)}


def test_lemmas_are_grouped_by_more_tasks_as_rows_grow(spark, monkeypatch):
    from corpusq.operators import joins

    monkeypatch.setattr(joins, "ROWS_PER_GROUPING_TASK", 10)
    postings = spark.range(500).select(
        F.lit("body").alias("field"), F.concat(F.lit("walk"), F.col("id") % 2).alias("term"), (F.col("id") % 250).alias("doc_id"),
        F.lit(1).cast("bigint").alias("tf"), F.lit(2).cast("bigint").alias("dl"),
    )
    lemmas = spark.createDataFrame([("walk0", "walk"), ("walk1", "walk")], "form STRING, lemma STRING")
    found = P.lemma_postings(postings, lemmas)
    assert found.rdd.getNumPartitions() == 51
    assert {(r.term, r.tf) for r in found.collect()} == {("walk", 2)} and found.count() == 250


# The same classes with Python's engine, as one alternation with seven groups.
_PYTHON = re.compile(
    rf"({typed.DATE})|({typed.TIME})|({typed._PERCENT})|({typed._NUMBER})|({typed._WORD})|(\s+)|(.)",
    re.IGNORECASE | re.MULTILINE,
)


def python_typed(text):
    return [(m.group(), typed.CLASSES[m.lastindex - 1]) for m in _PYTHON.finditer(text)]


@pytest.mark.parametrize(
    "text",
    [
        "On 9 October 2021 and Mar 26, 2020 at 10:30:05 or 1.30PM, 0930a.m. -7 and 1,234.5 rose 12% today",
        "Feb 26, 2020; 50 percent (42) 9am x9 don't well-known dogs' a 5 Feb26 , 2020 31 January 1999",
        "3.1415 +12 1,000,000.50 99% 100%! 23:59:59 24:00:00\nNew line 7\n8 eight 28 February 2001",
        "été à 5% naïve 日本 12:00:00",
        "a b c\r\nd",
    ],
)
def test_typed_tokens_match_python(spark, text):
    df = spark.createDataFrame([(text,)], "text STRING")
    got = [(t.token, t.cls) for t in df.select(typed.typed_tokens(F.col("text"))).first()[0]]
    assert got == python_typed(text)


def test_typed_tokens_of_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for text, found in docs.select("text", typed.typed_tokens(F.col("text"))).collect():
        assert [(t.token, t.cls) for t in found] == python_typed(text)
        assert "".join(t.token for t in found) == text


def test_typed_examples(spark):
    df = spark.createDataFrame([("Call Mar 26, 2020 at 10:30:05 for 12% of -7",)], "text STRING")
    found = df.select(typed.typed_tokens(F.col("text"))).first()[0]
    classes = {t.token: t.cls for t in found if t.cls != "SPACE"}
    assert classes == {
        "Call": "WORD", "Mar 26, 2020": "DATE", "at": "WORD", "10:30:05": "TIME", "for": "WORD",
        "12%": "PERCENT", "of": "WORD", "-7": "NUMBER",
    }


def test_class_counts(spark):
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = docs.select("text", typed.typed_tokens(F.col("text")).alias("found"))
    for row in found.select("text", *typed.class_counts(F.col("found"))).collect():
        counts = Counter(cls for _, cls in python_typed(row.text))
        assert {c: row[c] for c in typed.CLASSES} == {c: counts[c] for c in typed.CLASSES}


def test_typed_tokens_take_one_pass_over_texts_without_marks(spark):
    plain = ["On 9 October 2021 at 10:30:05 don't a-bc-d 5% été", "", None]
    marked = ["a \x01 b", "\x02", "12% \x02\x01 9.05PM\x01"]
    df = spark.createDataFrame([(t,) for t in plain + marked], "text STRING")
    found = df.select("text", typed.typed_tokens(F.col("text")).alias("found"))
    # The passes by group stand behind the condition that a mark is there.
    assert "regexp_replace" in found._jdf.queryExecution().optimizedPlan().toString()
    for text, got in found.collect():
        assert got == (None if text is None else python_typed(text)), text


def test_typed_sql_walks_as_python_does():
    """The SQL twin on lines that hold every class, dates across blanks, nulls and random mixtures."""
    import random

    import duckdb
    from corpusq.registry.typed_sql import TOKEN_CLASS_COUNTS, TYPED_TOKENS

    rng = random.Random(5)
    parts = [
        "9", " ", "October", "2021", ",", "a", "'", "-", ".", "%", "(", "\n", "é", "Feb", "12", ":30:05", "PM", "a.m.", "_", "+",
        "1,234", "x-y", "\t", "日", "\u00a0",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(1_000)]
    texts += [
        "", None, "9 October 2021,9 October 2021 x", "1 May 2020-1 May 2020-Jun 3, 1999 dogs'\ndogs' 12%",
        "Feb 26, 2020; 50 percent (42) 9am x9 don't well-known dogs' a 5 Feb26 , 2020 31 January 1999",
        "3.1415 +12 1,000,000.50 99% 100%! 23:59:59 24:00:00\nNew line 7\n8 eight 28 February 2001",
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    found = {}
    for doc_id, token, cls in con.execute(f"SELECT doc_id, token, cls FROM ({TYPED_TOKENS}) ORDER BY doc_id, pos").fetchall():
        found.setdefault(doc_id, []).append((token, cls))
    want = {i: python_typed(text) for i, text in enumerate(texts) if text}
    assert found == want
    assert {cls for tokens in want.values() for _, cls in tokens} == set(typed.CLASSES)
    counts = con.execute(f"SELECT doc_id, {', '.join(typed.CLASSES)} FROM ({TOKEN_CLASS_COUNTS})").fetchall()
    for doc_id, *row in counts:
        classes = [cls for _, cls in want.get(doc_id, [])]
        expected = [None] * 7 if texts[doc_id] is None else [classes.count(c) for c in typed.CLASSES]
        assert row == expected
    assert len(counts) == len(texts)
