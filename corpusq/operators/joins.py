"""Joins whose smaller side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.sources.storage import materialize

# A broadcast side holds at most this many rows. Rows are an id or a term of at
# most 50 characters plus a few numbers, so the table stays under about 100 MB.
BROADCAST_ROWS = 500_000

# Beyond that, a key is spread over one task for so many of its rows.
ROWS_PER_SALT = 2_000_000

# A key that is looked up more often is joined by broadcast.
HOT_LOOKUPS = 100_000

# A task groups about this many rows where grouping hardly makes them fewer.
ROWS_PER_GROUPING_TASK = 1_000_000

# Inputs of fewer splits are dealt out, whatever the number of cores.
FEW_SPLITS = 256


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal out a scan that has fewer splits than the cluster has cores, and few at all.

    A corpus of many files passes through untouched; only a scan of at most
    ``FEW_SPLITS`` splits is shuffled, so that the costly text work uses every
    core. An input that shuffles on its own passes as well: it is dealt out already, and asking
    for its partitions would run it.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < min(cores, FEW_SPLITS) else df


def deal_out(rows: DataFrame, count: int, *keys: str) -> DataFrame:
    """Rows by the hash of some keys over so many tasks that none groups many more than ``ROWS_PER_GROUPING_TASK``.

    ``count`` is how many rows there are, about. A grouping by the keys needs no other shuffle then. Without this, a
    task gathers the groups of its whole share of the scan, which grows with the files, and then those
    of one of a fixed number of partitions.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, count // ROWS_PER_GROUPING_TASK + 1), *keys)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a table is small enough to send to every executor; counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def sized_join(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    spread: str,
    small_fits: bool | None = None,
    rows: str | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Join by broadcast where the measured size allows, else by a shuffle.

    ``large`` may repeat a key without bound. Where a
    column ``rows`` of ``small`` says how often a key occurs in ``large``, keys above
    ``rows_per_salt`` are spread over several tasks by the hash of column
    ``spread``, and only their rows of ``small`` are repeated; all others are joined
    as they are. Without it adaptive execution splits the partitions of hot keys.
    Any join type that keeps or filters rows of ``large`` gives the same rows.
    """
    if small_fits is None:
        small_fits = fits_broadcast(small)
    if small_fits:
        return large.join(F.broadcast(small), on, how)
    if rows is None:
        return large.join(small, on, how)
    salts = F.greatest(F.lit(1), F.ceil(F.col(rows) / rows_per_salt)).cast("int")
    hot = small.groupBy(*on).agg(F.max(rows).alias(rows)).where(salts > 1).select(*on, salts.alias("_salts"))
    if not fits_broadcast(hot):
        return large.join(small, on, how)
    salted = large.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(F.hash(spread), F.coalesce("_salts", F.lit(1)))
    )
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.drop("_salts").join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup(rows: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """Attach large keyed tables to a few rows, keeping rows without a partner.

    An outer join cannot broadcast the side it preserves, so the plain join would
    shuffle the whole table. Instead the wanted keys are broadcast to cut every
    table down first. ``rows`` should be cheap to read several times. With too many
    keys to broadcast the joins are shuffles, for all rows but those of keys that are asked for
    more than ``HOT_LOOKUPS`` times: their few table rows are broadcast. Rows
    without a key have no partner and are not joined.
    """
    keys = rows.select(key).distinct()
    if fits_broadcast(rows) or fits_broadcast(keys):
        for table in tables:
            rows = rows.join(table.join(F.broadcast(keys), key, "left_semi"), key, "left")
        return rows
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_times"))
    hot = materialize(counts.where(F.col("_times") > HOT_LOOKUPS).select(key), "hot_keys")
    keyed, parts = rows.where(F.col(key).isNotNull()), []
    if not hot.isEmpty() and fits_broadcast(hot):
        often = keyed.join(F.broadcast(hot), key, "left_semi")
        for table in tables:
            often = often.join(F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key, "left")
        parts, keyed = [often], keyed.join(F.broadcast(hot), key, "left_anti")
    none = rows.where(F.col(key).isNull())
    for table in tables:
        keyed = keyed.join(table, key, "left")
        none = none.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name != key])
    for part in [*parts, none]:
        keyed = keyed.unionByName(part)
    return keyed
