"""The stored index: written, opened, extended, compacted, read by term, deleted.

Layout below the index path::

    doc_terms/batch=N/                     doc_id, dl, one array of (term, tf) per field
    postings/batch=N/field=F/bucket=B/     term, doc_id, tf, dl sorted by term, doc_id
    term_stats/batch=N/field=F/bucket=B/   term, df, cf: what the batch adds to them
    block_bounds/batch=N/field=F/bucket=B/ term, block and bounds of tf and dl, of the batch's dense terms
    lemmas/batch=N/, stop_words/batch=N/   word tables, of the batch that set them
    by_document/batch=N/field=F/           a second copy of all postings in files by document, if wanted
    corpus_stats/gen=N/                    one row: totals, live batches, how the index was analysed

A generation is a row of ``corpus_stats``, written last; it names the batches that are
live. Builds, appends and compactions write a batch of their own and then a
generation, so a failed one changes nothing for readers, and a repeated one replaces what
a failed one left behind. A build or compaction leaves the generation before it readable and removes older
ones. An append writes rows in proportion to its batch only: statistics and link texts of
several batches are added up on reading. Postings and statistics are stored of all
terms; ``min_df`` is applied on reading, so that a term that becomes frequent by an append
is there with all its postings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusq.functions.text import STOP_WORDS, term_bucket, term_bucket_of
from corpusq.functions.weights import ratio
from corpusq.operators import postings as P
from corpusq.operators.joins import sized_join
from corpusq.sources.storage import delete_path, names_in, path_exists, read_bucketed, write_bucketed

NUM_BUCKETS = 124

ANCHOR = "anchor"

# At most this many terms become literals of a pushed-down filter.
LITERAL_TERMS = 5_000

# Size of a row group of terms: small enough that most hold none of a batch's terms.
ROW_GROUP_BYTES = 16 * 2**20

# Documents of a block, on average; a block is a span of ids chosen per batch.
BLOCK_DOCS = 64

# Postings of a file of the layout by document: a task sorts so many, and adds up the scores of their documents.
SEGMENT_ROWS = 2_000_000

# A term has bounds per block if it is in more than one of so many documents of a batch; others have
# hardly more postings than blocks.
DENSE_SHARE = 16

TABLES = ("corpus_stats", "term_stats", "block_bounds", "postings", "doc_terms", "by_document", "lemmas", "stop_words")

POSTINGS_SCHEMA = "term STRING, doc_id BIGINT, tf BIGINT, dl BIGINT, batch INT, field STRING, bucket INT"
TERM_STATS_SCHEMA = "term STRING, df BIGINT, cf BIGINT, batch INT, field STRING, bucket INT"
BOUNDS_SCHEMA = "term STRING, block BIGINT, max_tf BIGINT, min_dl BIGINT, min_span DOUBLE, batch INT, field STRING, bucket INT"
CORPUS_STATS_SCHEMA = (
    "n BIGINT, total_len BIGINT, num_buckets INT, fields ARRAY<STRING>, min_df INT, binary_tf BOOLEAN, length_field STRING, "
    "stop ARRAY<STRING>, stop_batch INT, lemma_batch INT, words STRING, "
    "batches ARRAY<STRUCT<no: INT, first: BIGINT, span: BIGINT, n: BIGINT, total_len: BIGINT>>, gen INT"
)


@dataclass(frozen=True)
class Analysis:
    """How an index counts, stored with it: searches and appends keep to it."""

    min_df: int = 0
    binary_tf: bool = False
    length_field: str | None = None


@dataclass(frozen=True)
class Words:
    """The word tables of an index: its stop list (words, or a long table) and its lemmas.

    ``fingerprint`` is the same for tables with the same rows in any order. ``stop_batch`` and ``lemma_batch`` tell
    where tables are stored; a short stop list is in the generation itself.
    """

    stop: P.StopWords = STOP_WORDS
    lemmas: DataFrame | None = None
    fingerprint: str = ""
    stop_batch: int | None = None
    lemma_batch: int | None = None


@dataclass(frozen=True)
class Part:
    """A live batch: its number, what its blocks are, what it adds to the totals."""

    no: int
    first: int
    span: int
    n: int
    total_len: int

    @property
    def block(self) -> Column:
        return F.floor((F.col("doc_id") - F.lit(self.first)) / F.lit(self.span)).cast("bigint")


@dataclass(frozen=True)
class Index:
    """An opened index. The scalars are those of its one-row corpus statistics."""

    path: str
    gen: int
    n: int
    total_len: int
    num_buckets: int
    fields: tuple[str, ...]
    analysis: Analysis
    words: Words
    parts: tuple[Part, ...]
    all_postings: DataFrame = field(repr=False)
    all_stats: DataFrame = field(repr=False)
    block_bounds: DataFrame = field(repr=False)
    doc_terms: DataFrame = field(repr=False)

    @property
    def avg_dl(self) -> float:
        return self.total_len / self.n if self.n else 0.0

    @property
    def doc_len(self) -> DataFrame:
        """``(doc_id, dl)``, with 0 for a document that keeps no token."""
        return self.doc_terms.select("doc_id", "dl")

    @property
    def term_stats(self) -> DataFrame:
        """``(field, bucket, term, df, cf)`` of the terms that ``min_df`` shows."""
        low = self.analysis.min_df
        return self.all_stats.where(F.col("df") > low) if low > 0 else self.all_stats

    @cached_property
    def postings(self) -> DataFrame:
        """``(field, bucket, term, doc_id, tf, dl)`` of the terms that ``min_df`` shows."""
        if self.analysis.min_df <= 0:
            return self.all_postings
        keys = ["field", "bucket", "term"]
        shown = sized_join(self.all_postings, self.term_stats.select(*keys, "df"), keys, "left_semi", spread="doc_id", rows="df")
        return shown.select(*self.all_postings.columns)

    def corpus_stats(self) -> DataFrame:
        """``(n, total_len, avg_dl)`` as a one-row table."""
        stored = self.all_postings.sparkSession.read.schema(CORPUS_STATS_SCHEMA).parquet(f"{self.path}/corpus_stats")
        return stored.where(F.col("gen") == self.gen).select(
            "n", "total_len", ratio(F.col("total_len"), F.col("n")).alias("avg_dl")
        )

    def of_terms(self, table: DataFrame, terms: Iterable[str] | None) -> DataFrame:
        """Rows of ``postings`` or ``term_stats`` for some terms.

        The buckets of the terms prune directories; the terms themselves reach
        the parquet scan, where sort order and Bloom filters let whole row groups be skipped.
        """
        if terms is None:
            return table
        terms = sorted(set(terms))
        if len(terms) > LITERAL_TERMS:
            return table
        buckets = sorted({term_bucket_of(t, self.num_buckets) for t in terms})
        return table.where(F.col("bucket").isin(buckets) & _among(terms))

    def posting_list(self, term: str, field: str) -> DataFrame:
        """``(doc_id, tf)`` of one term, by document id; empty if the term is unknown."""
        hits = self.of_terms(self.postings.where(F.col("field") == field), [term])
        return hits.select("doc_id", "tf").orderBy("doc_id")

    def stats_of_batches(self) -> DataFrame:
        """``(batch, field, bucket, term, df, cf)``: what each batch adds to the statistics."""
        return _stored_stats(self.all_stats.sparkSession, self.path, self.parts)

    def blocked_postings(self) -> DataFrame:
        """All postings with the ``batch`` and ``block`` that their bounds are filed under."""
        stored = _stored_postings(self.all_postings.sparkSession, self.path, self.parts)
        block = F.lit(None).cast("bigint")
        for part in self.parts:
            block = F.when(F.col("batch") == part.no, part.block).otherwise(block)
        return stored.withColumn("block", block)


def write_index(
    docs: DataFrame,
    path: str,
    fields: Sequence[str] = ("body",),
    *,
    anchors: DataFrame | None = None,
    stop: P.StopWords = STOP_WORDS,
    lemmas: DataFrame | None = None,
    binary_tf: bool = False,
    min_df: int = 0,
    length_field: str | None = None,
    num_buckets: int = NUM_BUCKETS,
) -> Index:
    """Build an index from documents and store it, replacing one already there.

    ``docs`` has ``doc_id`` and one text column per field. ``anchors(target_id,
    text)`` adds a field ``anchor`` posted under the target. Terms of no more than
    ``min_df`` documents are stored and not shown. Repeated document ids are refused.
    The old index stays until the new one is complete, and can be read after that by those who
    have opened it, until the next build or compaction.
    """
    spark, analysis = docs.sparkSession, Analysis(min_df, binary_tf, length_field)
    last = _last_generation(spark, path)
    batch = _Batch(spark, path, last.gen + 1 if last else 0, num_buckets)
    words = _store_words(batch, stop, lemmas)
    fields = [*fields, ANCHOR] if anchors is not None else list(fields)
    part = _write_batch(batch, docs, anchors, fields, analysis, words, None)
    batch.commit([part], fields, analysis, words)
    clean_index(spark, path, keep=2)
    return open_index(spark, path)


def append_documents(
    index: Index,
    docs: DataFrame,
    *,
    anchors: DataFrame | None = None,
    stop: P.StopWords | None = None,
    lemmas: DataFrame | None = None,
) -> Index:
    """Add new documents, and new link texts to the field of link texts.

    Only the batch is analysed and written, as the index was: with its stop list, lemmas and
    settings. ``stop`` and ``lemmas`` need not be given; other ones than
    those of the index are refused, and so are ids that the index or the batch already
    has, links for an index without that field, and an index opened before another append. A
    refused batch leaves nothing behind. New links may point to any page, also to one with older links: a
    term that the page already had counts no further document, only its occurrences.
    """
    if anchors is not None and ANCHOR not in index.fields:
        raise ValueError("the index has no link texts")
    spark, words = docs.sparkSession, index.words
    if stop is not None or lemmas is not None:
        given = _fingerprint(words.stop if stop is None else stop, words.lemmas if lemmas is None else lemmas)
        if given != words.fingerprint:
            raise ValueError("the index was built with other stop words or lemmas")
    batch = _Batch(spark, index.path, index.gen + 1, index.num_buckets)
    if path_exists(spark, batch.committed):
        raise ValueError("the index has grown since it was opened")
    part = _write_batch(batch, docs, anchors, index.fields, index.analysis, words, index)
    batch.commit([*index.parts, part], index.fields, index.analysis, words)
    return open_index(spark, index.path)


def compact_index(index: Index) -> Index:
    """Merge all live batches into one: sorted once, link texts and statistics added up, bounds made anew.

    The generation before stays readable until the next build or compaction; older ones and
    batches that no generation names are removed. An index of one batch is laid out again as well.
    """
    spark, words = index.doc_terms.sparkSession, index.words
    batch = _Batch(spark, index.path, index.gen + 1, index.num_buckets)
    if path_exists(spark, batch.committed):
        raise ValueError("the index has grown since it was opened")
    doc_terms = _write_doc_terms(index.doc_terms, index.path, batch.no)
    part = _part_of(doc_terms, batch.no)

    def write_field(name: str) -> None:
        rows = index.all_postings.where(F.col("field") == name).select("term", "doc_id", "tf", "dl")
        batch.write_postings(name, rows)
        stats = index.all_stats.where(F.col("field") == name).select("bucket", "term", "df", "cf")
        batch.write_term_stats(name, stats)
        batch.write_block_bounds(name, part)

    _each(spark, write_field, index.fields)
    if words.lemma_batch is not None or words.stop_batch is not None:
        words = _store_words(batch, words.stop, words.lemmas)
    batch.commit([part], index.fields, index.analysis, words)
    clean_index(spark, index.path, keep=2)
    return open_index(spark, index.path)


def lay_out_by_document(index: Index, field: str, segments: int | None = None) -> None:
    """Store the postings of a field a second time, in ``segments`` files by the hash of the document, sorted by term.

    All postings of a document are then read by one task, so that its score is
    complete without a shuffle of matches. The copy belongs to this generation; a grown or
    rebuilt index needs a new one.
    """
    rows = index.all_postings.where(F.col("field") == field).select("bucket", "term", "doc_id", "tf", "dl")
    if segments is None:
        segments = max(rows.count() // SEGMENT_ROWS + 1, index.doc_terms.sparkSession.sparkContext.defaultParallelism)
    path = f"{index.path}/by_document/batch={index.gen}/field={field}"
    delete_path(rows.sparkSession, f"{index.path}/by_document/batch={index.gen}/segments-{field}")
    write_bucketed(rows.repartition(segments, "doc_id"), path, "doc_id", segments, ("bucket", "term"))
    # Written last: without it the copy does not exist.
    rows.sparkSession.range(1).select(F.lit(segments).alias("segments")).write.parquet(f"{index.path}/by_document/batch={index.gen}/segments-{field}")


def postings_by_document(index: Index, field: str) -> DataFrame | None:
    """``(field, bucket, term, doc_id, tf, dl)`` of such a copy, None if this generation has none."""
    spark, base = index.doc_terms.sparkSession, f"{index.path}/by_document/batch={index.gen}"
    if not path_exists(spark, f"{base}/segments-{field}"):
        return None
    segments = spark.read.schema("segments INT").parquet(f"{base}/segments-{field}").first().segments
    schema = StructType.fromDDL("bucket INT, term STRING, doc_id BIGINT, tf BIGINT, dl BIGINT")
    return read_bucketed(spark, f"{base}/field={field}", schema, "doc_id", segments).withColumn("field", F.lit(field))


def clean_index(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all but the last ``keep`` generations, and the batches that none of those left names.

    Not while a build, an append or a compaction is at work: its batch has no generation yet.
    """
    stored = spark.read.schema(CORPUS_STATS_SCHEMA).parquet(f"{path}/corpus_stats")
    rows = sorted(stored.select("gen", "batches.no", "stop_batch", "lemma_batch").collect(), key=lambda r: -r.gen)
    for row in rows[keep:]:
        delete_path(spark, f"{path}/corpus_stats/gen={row.gen}")
    left = {f"batch={no}" for r in rows[:keep] for no in [*r.no, r.gen, r.stop_batch, r.lemma_batch]}
    for table in TABLES[1:]:
        for name in set(names_in(spark, f"{path}/{table}")) - left:
            if name.startswith("batch="):
                delete_path(spark, f"{path}/{table}/{name}")


def open_index(spark: SparkSession, path: str) -> Index:
    """Open the last committed state of an index."""
    last = _last_generation(spark, path)
    if last is None:
        raise FileNotFoundError(f"PATH_NOT_FOUND: no index at {path}")
    parts = tuple(Part(**p.asDict()) for p in last.batches)
    counts = "".join(f", `{f}` ARRAY<STRUCT<term: STRING, tf: BIGINT>>" for f in last.fields if f != ANCHOR)
    doc_terms = spark.read.schema(f"doc_id BIGINT, dl BIGINT{counts}, batch INT").parquet(f"{path}/doc_terms")
    bounds = spark.read.schema(BOUNDS_SCHEMA).parquet(f"{path}/block_bounds")
    return Index(
        path=path,
        gen=last.gen,
        n=last.n,
        total_len=last.total_len,
        num_buckets=last.num_buckets,
        fields=tuple(last.fields),
        analysis=Analysis(last.min_df, last.binary_tf, last.length_field),
        words=_stored_words(spark, path, last),
        parts=parts,
        all_postings=_merged_postings(spark, path, parts, last.fields),
        all_stats=_merged_stats(spark, path, parts),
        block_bounds=_live(bounds, parts),
        doc_terms=_live(doc_terms, parts).drop("batch"),
    )


def delete_index(spark: SparkSession, path: str) -> None:
    """Remove an index, the commit records first."""
    for table in TABLES:
        delete_path(spark, f"{path}/{table}")


def bucket_sizes(index: Index, field: str) -> DataFrame:
    """``(bucket, terms, postings)``: how evenly the buckets of a field are filled."""
    return (
        index.term_stats.where(F.col("field") == field)
        .groupBy("bucket")
        .agg(F.count("*").alias("terms"), F.sum("df").alias("postings"))
    )


@dataclass(frozen=True)
class _Batch:
    """Where one batch of documents goes.

    Fields are written one by one below a path of their own: a constant or
    nullable partition column would make the writer sort again, by partition
    only, and the order by term would be lost.
    """

    spark: SparkSession
    path: str
    no: int
    num_buckets: int

    @property
    def committed(self) -> str:
        return f"{self.path}/corpus_stats/gen={self.no}"

    def write_postings(self, field: str, rows: DataFrame) -> None:
        laid_out = rows.drop("field").withColumn("bucket", term_bucket(F.col("term"), self.num_buckets))
        _write_bucketed(laid_out, ["term", "doc_id"], self._at("postings", field))

    def stored_postings(self, field: str) -> DataFrame:
        schema = "term STRING, doc_id BIGINT, tf BIGINT, dl BIGINT, bucket INT"
        return self.spark.read.schema(schema).parquet(self._at("postings", field))

    def term_stats(self, field: str) -> DataFrame:
        """``(bucket, term, df, cf)`` of the postings written for this batch."""
        return P.term_statistics(self.stored_postings(field), ["bucket", "term"])

    def write_term_stats(self, field: str, stats: DataFrame) -> None:
        _write_bucketed(stats, ["term"], self._at("term_stats", field))

    def write_block_bounds(self, field: str, part: Part) -> None:
        """Bounds per block of the terms in more than one of ``DENSE_SHARE`` documents of the batch."""
        stats = self.spark.read.schema("term STRING, df BIGINT, cf BIGINT, bucket INT").parquet(self._at("term_stats", field))
        dense = stats.where(F.col("df") * DENSE_SHARE > part.n).select("bucket", "term")
        # There are at most DENSE_SHARE times the terms of an average document.
        rows = sized_join(self.stored_postings(field), dense, ["bucket", "term"], "left_semi", spread="doc_id")
        bounds = rows.groupBy("bucket", "term", part.block.alias("block")).agg(
            F.max("tf").alias("max_tf"),
            F.min(F.coalesce("dl", F.lit(0))).alias("min_dl"),
            F.min(F.coalesce("dl", F.lit(0)) / F.col("tf")).alias("min_span"),
        )
        _write_bucketed(bounds, ["term", "block"], self._at("block_bounds", field))

    def commit(self, parts: Sequence[Part], fields: Sequence[str], analysis: Analysis, words: Words) -> None:
        stop = None if isinstance(words.stop, DataFrame) else sorted(set(words.stop))
        row = (
            sum(p.n for p in parts), sum(p.total_len for p in parts), self.num_buckets, list(fields), analysis.min_df, analysis.binary_tf,
            analysis.length_field, stop, words.stop_batch, words.lemma_batch, words.fingerprint, [(p.no, p.first, p.span, p.n, p.total_len) for p in parts],
        )
        schema = CORPUS_STATS_SCHEMA.removesuffix(", gen INT")
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("errorifexists").parquet(self.committed)

    def remove(self) -> None:
        for table in TABLES[1:]:
            delete_path(self.spark, f"{self.path}/{table}/batch={self.no}")

    def _at(self, table: str, field: str) -> str:
        return f"{self.path}/{table}/batch={self.no}/field={field}"


def _write_batch(
    batch: _Batch, docs: DataFrame, anchors: DataFrame | None, fields: Sequence[str], analysis: Analysis, words: Words, before: Index | None
) -> Part:
    """Analyse documents and links and write all their tables; ``before`` is the index they are added to."""
    texts = [f for f in fields if f != ANCHOR]
    stop = words.stop
    doc_terms = _write_doc_terms(P.document_terms(docs, texts, stop, length_field=analysis.length_field), batch.path, batch.no)
    part = _part_of(doc_terms, batch.no)
    ids = doc_terms.select("doc_id")
    again = not ids.groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1").isEmpty()
    if again or before is not None and not before.doc_terms.select("doc_id").join(ids, "doc_id", "left_semi").isEmpty():
        batch.remove()
        raise ValueError("the batch has some ids twice" if again else "the index already has some of these documents")

    def write_field(name: str) -> None:
        if name != ANCHOR:
            batch.write_postings(name, _analysed(doc_terms, name, stop, words.lemmas, analysis.binary_tf))
            stats = batch.term_stats(name)
        else:
            links = anchors if anchors is not None else docs.sparkSession.createDataFrame([], "target_id BIGINT, text STRING")
            batch.write_postings(name, P.anchor_postings(links, stop, ANCHOR))
            stats = batch.term_stats(name) if before is None else _added_link_stats(batch.stored_postings(name), before)
        batch.write_term_stats(name, stats)
        batch.write_block_bounds(name, part)

    _each(batch.spark, write_field, fields)
    return part


def _added_link_stats(rows: DataFrame, before: Index) -> DataFrame:
    """What link texts add to the statistics: a (term, target) that the index has adds to ``cf`` only."""
    keys = ["bucket", "term", "doc_id"]
    stored = before.all_postings.where(F.col("field") == ANCHOR).select(*keys)
    known = sized_join(stored, rows.select(*keys), keys, "left_semi", spread="doc_id").withColumn("known", F.lit(True))
    marked = rows.join(known, keys, "left")
    new = F.sum(F.when(F.col("known").isNull(), F.lit(1)).otherwise(0))
    return marked.groupBy("bucket", "term").agg(new.alias("df"), F.sum("tf").alias("cf"))


def _part_of(doc_terms: DataFrame, no: int) -> Part:
    """Totals of a batch, and the span of ids that holds ``BLOCK_DOCS`` documents on average."""
    n, total, first, last = doc_terms.agg(
        F.count("*"), F.coalesce(F.sum("dl"), F.lit(0)), F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0))
    ).first()
    return Part(no, first, max(1, (last - first + 1) * BLOCK_DOCS // max(n, 1)), n, total)


def _analysed(
    doc_terms: DataFrame, field: str, stop: P.StopWords, lemmas: DataFrame | None, binary_tf: bool
) -> DataFrame:
    rows = P.postings_of(doc_terms, [field])
    if lemmas is not None:
        rows = P.lemma_postings(rows, lemmas, stop, binary_tf)
    elif binary_tf:
        rows = rows.withColumn("tf", F.lit(1).cast("bigint"))
    return rows


def _last_generation(spark: SparkSession, path: str) -> Row | None:
    if not any(name.startswith("gen=") for name in names_in(spark, f"{path}/corpus_stats")):
        return None
    return spark.read.schema(CORPUS_STATS_SCHEMA).parquet(f"{path}/corpus_stats").orderBy(F.desc("gen")).first()


def _live(table: DataFrame, parts: Sequence[Part]) -> DataFrame:
    return table.where(F.col("batch").isin([p.no for p in parts]))


def _stored_postings(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    return _live(spark.read.schema(POSTINGS_SCHEMA).parquet(f"{path}/postings"), parts)


def _merged_postings(spark: SparkSession, path: str, parts: Sequence[Part], fields: Sequence[str]) -> DataFrame:
    """Postings of all batches. Links to one page may be in several; a document's text is in one."""
    columns = ["term", "doc_id", "tf", "dl", "field", "bucket"]
    rows = _stored_postings(spark, path, parts)
    if ANCHOR not in fields or len(parts) == 1:
        return rows.select(*columns)
    links = rows.where(F.col("field") == ANCHOR).groupBy("field", "bucket", "term", "doc_id")
    links = links.agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
    return rows.where(F.col("field") != ANCHOR).select(*columns).unionByName(links.select(*columns))


def _stored_stats(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    return _live(spark.read.schema(TERM_STATS_SCHEMA).parquet(f"{path}/term_stats"), parts)


def _merged_stats(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    """Statistics of all terms, also of those that ``min_df`` hides."""
    rows = _stored_stats(spark, path, parts)
    if len(parts) > 1:
        rows = rows.groupBy("field", "bucket", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return rows.select("term", "df", "cf", "field", "bucket")


def _store_words(batch: _Batch, stop: P.StopWords, lemmas: DataFrame | None) -> Words:
    """Store lemmas and a stop list too long for the generation's row; read them from there from now on."""
    spark, stop_batch, lemma_batch = batch.spark, None, None
    short, table = P.stop_parts(stop)
    if table is not None:
        table.write.mode("overwrite").parquet(f"{batch.path}/stop_words/batch={batch.no}")
        stop_batch, table = batch.no, spark.read.schema("term STRING").parquet(f"{batch.path}/stop_words/batch={batch.no}")
    if lemmas is not None:
        lemmas.select("form", "lemma").write.mode("overwrite").parquet(f"{batch.path}/lemmas/batch={batch.no}")
        lemma_batch, lemmas = batch.no, spark.read.schema("form STRING, lemma STRING").parquet(f"{batch.path}/lemmas/batch={batch.no}")
    stop = table if table is not None else tuple(short)
    return Words(stop, lemmas, _fingerprint(stop, lemmas), stop_batch, lemma_batch)


def _stored_words(spark: SparkSession, path: str, last: Row) -> Words:
    stop, lemmas = last.stop, None
    if last.stop_batch is not None:
        stop = spark.read.schema("term STRING").parquet(f"{path}/stop_words/batch={last.stop_batch}")
    if last.lemma_batch is not None:
        lemmas = spark.read.schema("form STRING, lemma STRING").parquet(f"{path}/lemmas/batch={last.lemma_batch}")
    return Words(stop if isinstance(stop, DataFrame) else tuple(stop), lemmas, last.words, last.stop_batch, last.lemma_batch)


def _fingerprint(stop: P.StopWords, lemmas: DataFrame | None) -> str:
    """Tells word tables apart by their rows, whatever their order and form: words, or a table."""

    def of(rows: DataFrame) -> str:
        distinct = rows.distinct().select(F.xxhash64(*rows.columns).alias("h"))
        return "{}:{}".format(*distinct.agg(F.count("*"), F.coalesce(F.bit_xor("h"), F.lit(0))).first())

    short, table = P.stop_parts(stop)
    if table is None and lemmas is None:
        # No job for what is at hand.
        return f"words {len(short)}:{hash_of(short)}"
    words = of(table) if table is not None else f"{len(short)}:{hash_of(short)}"
    return f"words {words}" + ("" if lemmas is None else f" lemmas {of(lemmas.select('form', 'lemma'))}")


def hash_of(words: Sequence[str]) -> str:
    """A digest of a sorted list of words."""
    return hashlib.sha256("\n".join(words).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _write_doc_terms(doc_terms: DataFrame, path: str, batch: int) -> DataFrame:
    target = f"{path}/doc_terms/batch={batch}"
    doc_terms.write.mode("overwrite").parquet(target)
    return doc_terms.sparkSession.read.schema(doc_terms.schema).parquet(target)


def _among(terms: Sequence[str]) -> Column:
    """Whether ``term`` is one of some terms, as one expression: a literal each would be thousands of calls."""
    if not terms:
        return F.lit(False)
    return F.expr("term IN (" + ", ".join(f"CAST(X'{t.encode().hex()}' AS STRING)" for t in terms) + ")")


def _write_bucketed(rows: DataFrame, order: list[str], target: str, row_group_bytes: int | None = None) -> None:
    """One directory per bucket, sorted inside the files.

    Rebalancing leaves the partition sizes to adaptive execution: a bucket that
    holds a very frequent term is split over many tasks, small ones are joined.
    Each row group has a Bloom filter of its terms, as large as they need: the bounds of
    a row group say little about a batch of thousands of terms.
    """
    row_group_bytes = ROW_GROUP_BYTES if row_group_bytes is None else row_group_bytes
    (
        rows.hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", *order)
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#term", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("bucket")
        .parquet(target)
    )


def _each(spark: SparkSession, work: Callable[[str], None], fields: Sequence[str]) -> None:
    """Write the fields side by side; each is a few jobs that leave cores idle at their end."""
    with ThreadPoolExecutor(len(fields)) as pool:
        list(pool.map(inheritable_thread_target(spark)(work), fields))
