"""Norms that follow an index: kept as sums that do not depend on the number of documents.

The squared norm of a document, the sum of ``(tf * ln(n / df))**2``, is
``ln(n)**2 * a - 2 * ln(n) * b + c`` with the sums ``a`` of ``tf**2``, ``b`` of ``tf**2 * ln(df)``
and ``c`` of ``tf**2 * ln(df)**2``. An append changes ``n`` for all documents, which costs nothing
here, and ``df`` for some terms: only those terms change the sums of older documents.

A term of one document adds nothing to ``b`` and ``c``, so its statistics are not looked up. The most frequent of
the others are broadcast, so that most postings are not shuffled before they are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.functions.weights import IDF_EPSILON, ratio
from corpusq.operators import joins
from corpusq.operators.index import Index
from corpusq.sources.storage import materialize


def norm_sums(index: Index, field: str = "body") -> DataFrame:
    """``(doc_id, dl, a, b, c)`` of every document with a term in the field."""
    return _sums(_of(index.all_postings, field), _of(index.all_stats, field))


def norm_sums_after_append(sums: DataFrame, before: Index, after: Index, field: str = "body") -> DataFrame:
    """The sums of a grown index from those of the index before it.

    New documents are summed up; older ones change by what the new document frequencies of
    their terms add, for the terms that the appended batches hold. ``after`` must be
    ``before`` with batches added.
    """
    old = sorted(p.no for p in before.parts)
    if not set(old) < {p.no for p in after.parts}:
        raise ValueError("not an index with batches added")
    of_old = F.col("batch").isin(old)
    stats = _of(after.stats_of_batches(), field).groupBy("term")
    stats = stats.agg(F.sum("df").alias("df"), F.sum(F.when(of_old, F.col("df"))).alias("was"), F.bool_or(~of_old).alias("touched"))
    touched = materialize(stats.where("touched").drop("touched"), "touched_terms")
    b, c = F.log("df") - F.log("was"), F.log("df") * F.log("df") - F.log("was") * F.log("was")
    changed = touched.where("was <> df").select("term", b.alias("b"), c.alias("c"), F.col("was").alias("times"))
    more = _added_up(_weighted(_of(before.all_postings, field), changed, "inner"))
    more = more.select("doc_id", F.col("b").alias("more_b"), F.col("c").alias("more_c"))
    none = F.lit(0.0)
    grown = sums.join(more, "doc_id", "left").select(
        "doc_id", "dl", "a", (F.col("b") + F.coalesce("more_b", none)).alias("b"), (F.col("c") + F.coalesce("more_c", none)).alias("c")
    )
    added = _of(after.blocked_postings().where(~of_old), field)
    return grown.unionByName(_sums(added, touched))


def norms_of(sums: DataFrame, n: int) -> DataFrame:
    """``(doc_id, norm, weight_norm)`` for an index of ``n`` documents, as ``document_norms`` gives them.

    The ranking weights have ``ln(n / df + 1e-9)``; its difference from ``ln(n / df)``, at most 1e-9, counts
    in the last place only, but for documents all of whose terms are in every document: theirs is added.
    """
    size = F.log(F.lit(float(max(n, 1))))
    square = F.greatest(size * size * F.col("a") - 2 * size * F.col("b") + F.col("c"), F.lit(0.0))
    # What rounding leaves of a sum that is zero is far below any real one.
    square = F.when(square > F.lit(1e-12) * (1 + size * size) * F.col("a"), square).otherwise(0.0)
    norm = F.sqrt(square)
    smooth = F.when(norm > 0, norm).otherwise(F.sqrt("a") * IDF_EPSILON)
    return sums.select("doc_id", norm.alias("norm"), ratio(smooth, F.col("dl")).alias("weight_norm"))


def _of(table: DataFrame, field: str) -> DataFrame:
    return table.where(F.col("field") == field)


def _sums(postings: DataFrame, stats: DataFrame) -> DataFrame:
    log = F.log("df")
    repeated = stats.where("df > 1").select("term", log.alias("b"), (log * log).alias("c"), F.col("df").alias("times"))
    return _added_up(_weighted(postings, materialize(repeated, "repeated_terms"), "left"))


def _weighted(postings: DataFrame, terms: DataFrame, how: str) -> DataFrame:
    """``(doc_id, dl, a, b, c)`` of postings, with ``b`` and ``c`` of ``terms(term, b, c, times)``.

    With ``left`` postings without a row in ``terms`` are there as well. ``times`` tells how often a term occurs:
    where not all terms can be broadcast, the most frequent are, and only postings of the others are shuffled,
    which add their ``b`` and ``c`` in rows of their own.
    """
    square = F.col("tf") * F.col("tf")
    weights = [(square * F.coalesce(w, F.lit(0.0))).alias(w) for w in ("b", "c")]
    least = _least_broadcast(terms)
    often = F.broadcast(terms.where(F.col("times") >= least).drop("times"))
    rows = postings.join(often, "term", how).select("doc_id", "dl", square.alias("a"), *weights)
    if least <= 1:
        return rows
    seldom = postings.join(often.select("term"), "term", "left_anti").join(terms.where(F.col("times") < least), "term")
    return rows.unionByName(seldom.select("doc_id", "dl", F.lit(0).cast("bigint").alias("a"), *weights))


def _least_broadcast(terms: DataFrame) -> int:
    """The least power of two such that all terms that occur so often can be broadcast; 1 for all terms."""
    power = F.floor(F.log2("times")).cast("int")
    counts = dict(terms.groupBy(power.alias("power")).agg(F.count("*")).collect())
    least, kept = max(counts, default=0) + 1, 0
    while least > 0 and kept + counts.get(least - 1, 0) <= joins.BROADCAST_ROWS:
        least -= 1
        kept += counts.get(least, 0)
    return 2**least


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id").agg(
        F.max("dl").alias("dl"), F.sum("a").cast("double").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c")
    )
