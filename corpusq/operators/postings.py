"""From documents to postings and the statistics derived from them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from corpusq.functions.text import STOP_WORDS, kept_tokens, run_starts, runs_to_counts, tokens
from corpusq.functions.weights import idf, idf_smoothed, ratio
from corpusq.operators.joins import deal_out, sized_join, spread
from corpusq.sources.storage import materialize

# A stop list up to this size becomes a literal set inside the token filter.
STOP_LITERALS = 10_000

# Posting lists are cut into blocks of this many consecutive document ids, which
# bounds the array in a row however frequent its term is.
BLOCK_SPAN = 65_536

StopWords = Iterable[str] | DataFrame


def token_rows(docs: DataFrame, text: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, pos, term)``: every token with its position, stop words included."""
    docs = spread(docs.select(id_col, text), id_col)
    return docs.select(id_col, F.posexplode_outer(tokens(F.col(text))).alias("pos", "term")).where(
        F.col("pos").isNotNull()
    )


def kept_token_rows(
    docs: DataFrame, text: str, stop: StopWords = STOP_WORDS, id_col: str = "doc_id"
) -> DataFrame:
    """``(id, term)``: every token that is not a stop word."""
    words, table = stop_parts(stop)
    docs = spread(docs.select(id_col, text), id_col)
    rows = docs.select(id_col, F.explode_outer(kept_tokens(F.col(text), words)).alias("term"))
    return _without(rows.where(F.col("term").isNotNull()), table, spread=id_col)


def document_terms(
    docs: DataFrame,
    fields: Sequence[str],
    stop: StopWords = STOP_WORDS,
    *,
    length_field: str | None = None,
    id_col: str = "doc_id",
    is_scan: bool = True,
    stop_literals: int = STOP_LITERALS,
) -> DataFrame:
    """``(id, dl, field…)``: one row per document with its term counts per field.

    Each field column becomes ``array<struct<term, tf>>``; ``dl`` is the number of
    kept tokens of ``length_field`` (the last of ``fields`` unless named). Each
    field is tokenised once and nothing is shuffled, save for an input that
    ``is_scan`` of a few splits. A field may also be a list of tokens, which are
    counted as they are. A stop table of more than ``stop_literals`` words is
    joined instead; the rows are the same, ids may repeat.
    """
    length_field = length_field or fields[-1]
    docs = docs.select(id_col, *fields)
    given = {f for f in fields if isinstance(docs.schema[f].dataType, ArrayType)}
    words, table = stop_parts([] if given == set(fields) else stop, stop_literals)
    docs = spread(docs, id_col) if is_scan else docs

    def kept(f: str) -> Column:
        none = F.array().cast("array<string>")
        return F.coalesce(f, none) if f in given else kept_tokens(F.col(f), words)

    wide = docs.select(id_col, *[F.sort_array(kept(f)).alias(f) for f in fields])
    wide = wide.select("*", *[run_starts(F.col(f)).alias(f"{f}_starts") for f in fields])
    counted = wide.select(
        id_col,
        F.size(length_field).cast("bigint").alias("dl"),
        *[runs_to_counts(F.col(f), F.col(f"{f}_starts")).alias(f) for f in fields],
    )
    filtered = [f for f in fields if f not in given]
    return counted if table is None else _stop_by_table(counted, table, fields, filtered, length_field, id_col)


def postings_of(doc_terms: DataFrame, fields: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """``(field, term, doc_id, tf, dl)``: one row per term of a document's field.

    Of stored document terms each branch reads its own field only. The outer
    explode keeps the optimizer from inferring a filter on the array's size,
    which it would work out by counting the terms of the document once more.
    """
    return reduce(DataFrame.unionByName, [_field_postings(doc_terms, f, id_col) for f in fields])


def lemma_postings(
    postings: DataFrame, lemmas: DataFrame, stop: StopWords = STOP_WORDS, binary_tf: bool = False
) -> DataFrame:
    """Postings over lemmas: forms of one lemma in a document are added up.

    ``lemmas(form, lemma)`` has one row per form; a term without one stays as it
    is. ``binary_tf`` counts each lemma once per document.
    """
    words, table = stop_parts(stop)
    forms = lemmas.select(F.col("form").alias("term"), "lemma")
    mapped = sized_join(postings, forms, ["term"], "left", spread="doc_id").withColumn(
        "term", F.coalesce("lemma", "term")
    )
    kept = _without(mapped.where(~F.col("term").isin(words)) if words else mapped, table, spread="doc_id")
    tf = F.lit(1).cast("bigint") if binary_tf else F.sum("tf")
    # Not by the field: where it is a constant, Spark would not see that the rows lie right.
    dealt = deal_out(kept, postings.count(), "term", "doc_id")
    return dealt.groupBy("field", "term", "doc_id").agg(tf.alias("tf"), F.max("dl").alias("dl"))


def anchor_postings(
    anchors: DataFrame,
    stop: StopWords = STOP_WORDS,
    field: str = "anchor",
    stop_literals: int = STOP_LITERALS,
) -> DataFrame:
    """Postings of link texts under the page they point to.

    ``anchors(target_id, text)`` has one row per link. The counts of a link are
    made in its row and combined per target before the shuffle.
    """
    per_link = document_terms(
        anchors, ["text"], stop, id_col="target_id", is_scan=False, stop_literals=stop_literals
    )
    return (
        postings_of(per_link, ["text"], "target_id")
        .groupBy("term", "doc_id")
        .agg(F.sum("tf").alias("tf"))
        .select(F.lit(field).alias("field"), "term", "doc_id", "tf", F.lit(None).cast("bigint").alias("dl"))
    )


def term_statistics(postings: DataFrame, keys: Sequence[str] = ("term",)) -> DataFrame:
    """``(keys…, df, cf)``: documents and occurrences per term."""
    return postings.groupBy(*keys).agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def frequent_terms_only(postings: DataFrame, min_df: int) -> DataFrame:
    """Postings of the terms found in more than ``min_df`` documents.

    ``postings`` is read twice, so pass a stored table.
    """
    keys = ["field", "term"]
    stats = term_statistics(postings, keys).where(F.col("df") > min_df).select(*keys, "df")
    frequent = materialize(stats, "frequent")
    return sized_join(postings, frequent, keys, "left_semi", spread="doc_id", rows="df").drop("df")


def posting_lists(postings: DataFrame, block_span: int = BLOCK_SPAN) -> DataFrame:
    """``(term, block, postings)``: posting lists sorted by document id.

    A list comes in blocks of ``block_span`` consecutive ids; read in block order
    they are the whole list.
    """
    return (
        postings.groupBy("term", F.floor(F.col("doc_id") / block_span).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))
    )


def equal_posting_lists(postings: DataFrame, size: int = BLOCK_SPAN) -> DataFrame:
    """``(term, block, postings)``: posting lists sorted by document id, in blocks of equal numbers of rows.

    A list of up to ``size`` rows is one block; a longer one is cut into as few blocks as hold
    it, which differ by one row at most, however its ids are spread. Only long lists are
    numbered: they are range-partitioned and written, each stretch of a list is
    numbered on its own, and its rows in earlier partitions are added. ``postings`` is read several times,
    so pass a stored table.
    """
    pair = F.struct("doc_id", "tf")
    rows = postings.select("term", "doc_id", "tf")
    # One row per `size` postings at most.
    long = materialize(rows.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") > size), "long_lists")
    short = sized_join(rows, long.select("term"), ["term"], "left_anti", spread="doc_id").withColumn("block", F.lit(0).cast("bigint"))
    parts = sized_join(rows, long, ["term"], spread="doc_id", rows="df").repartitionByRange("term", "doc_id")
    parts = materialize(parts.withColumn("_part", F.spark_partition_id()), "long_postings")
    before = Window.partitionBy("term").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("term", "_part").agg(F.count("*").alias("_rows"))
    offsets = counts.select("term", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("term", "_part").orderBy("doc_id")) - 1
    numbered = parts.withColumn("_place", place).join(offsets, ["term", "_part"])
    blocks = F.ceil(F.col("df") / F.lit(size))
    block = F.floor((F.col("_place") + F.col("_before")) * blocks / F.col("df")).cast("bigint")
    cut = numbered.select("term", "doc_id", "tf", block.alias("block"))
    both = short.unionByName(cut)
    return both.groupBy("term", "block").agg(F.sort_array(F.collect_list(pair)).alias("postings"))


def document_norms(postings: DataFrame, term_stats: DataFrame, n: int) -> DataFrame:
    """``(doc_id, norm, weight_norm)``: vector lengths of the documents of one field.

    ``norm`` is over ``tf * ln(n/df)``; ``weight_norm`` over the ranking weights
    ``tf/dl * ln(n/df + 1e-9)``, the one a true cosine divides by. Where the length
    is 0 (that of another field may be) the ranking weight is 0.
    """
    plain = F.col("tf") * idf(n, F.col("df"))
    weight = ratio(F.col("tf"), F.col("dl")) * idf_smoothed(n, F.col("df"))
    stats = term_stats.select("term", "df")
    return (
        sized_join(postings, stats, ["term"], spread="doc_id", rows="df")
        .groupBy("doc_id")
        .agg(
            F.sqrt(F.sum(plain * plain)).alias("norm"),
            F.sqrt(F.sum(weight * weight)).alias("weight_norm"),
        )
    )


def sparse_rows(cells: DataFrame, row: str, block_span: int = BLOCK_SPAN) -> DataFrame:
    """``(row, block, entries)``: the non-zero ``(term_idx, value)`` pairs of each row.

    Like posting lists, a row comes in blocks of consecutive column numbers.
    """
    return (
        cells.where(F.col("value") != 0)
        .groupBy(row, F.floor(F.col("term_idx") / block_span).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("term_idx", "value"))).alias("entries"))
    )


def _field_postings(doc_terms: DataFrame, field: str, id_col: str) -> DataFrame:
    return (
        doc_terms.select(id_col, "dl", F.explode_outer(field).alias("t"))
        .where(F.col("t").isNotNull())
        .select(
            F.lit(field).alias("field"),
            F.col("t.term").alias("term"),
            F.col(id_col).alias("doc_id"),
            F.col("t.tf").alias("tf"),
            "dl",
        )
    )


def stop_parts(stop: StopWords, literals: int = STOP_LITERALS) -> tuple[list[str], DataFrame | None]:
    """A stop list as literals, or as a table when it is too long for that."""
    if not isinstance(stop, DataFrame):
        return sorted(set(stop)), None
    head = [r[0] for r in stop.limit(literals + 1).collect()]
    if len(head) <= literals:
        return sorted({w for w in head if w is not None}), None
    return [], stop.toDF("term").where("term is not null").distinct()


def _without(rows: DataFrame, table: DataFrame | None, spread: str) -> DataFrame:
    return rows if table is None else sized_join(rows, table, ["term"], "left_anti", spread=spread)


def _stop_by_table(
    doc_terms: DataFrame, table: DataFrame, fields: Sequence[str], filtered: Sequence[str], length_field: str, id_col: str
) -> DataFrame:
    """Drop the terms of a long stop table from the text fields and count the lengths anew.

    Rows are told apart by a number of their own, not by their id, which may
    repeat; a row gathers no more than its own terms.
    """
    numbered = materialize(doc_terms.withColumn("_row", F.monotonically_increasing_id()), "terms")
    kept = _without(postings_of(numbered, filtered, "_row"), table, spread="doc_id")
    entry = F.struct("term", "tf")
    again = kept.groupBy(F.col("doc_id").alias("_row")).agg(
        F.sum(F.when(F.col("field") == length_field, F.col("tf"))).alias("_dl"),
        *[F.sort_array(F.collect_list(F.when(F.col("field") == f, entry))).alias(f"_{f}") for f in filtered],
    )
    length = F.coalesce("_dl", F.lit(0).cast("bigint")) if length_field in filtered else F.col("dl")

    def terms(f: str) -> Column:
        none = F.array().cast(doc_terms.schema[f].dataType)
        return F.coalesce(f"_{f}", none).alias(f) if f in filtered else F.col(f)

    return numbered.join(again, "_row", "left").select(id_col, length.alias("dl"), *[terms(f) for f in fields])
