"""Consecutive numbers for the distinct values of a column, without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusq.sources.storage import materialize


def number_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """``(column, name)`` with ``name`` the 1-based rank of each distinct value.

    The values are range-partitioned, each partition is numbered on its own, and
    the partition totals (one row per partition) give the offsets.
    """
    parts = materialize(
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .repartitionByRange(column)
        .withColumn("_part", F.spark_partition_id()),
        "values",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return parts.join(F.broadcast(offsets), "_part").select(
        column, (within + F.col("_offset")).cast("bigint").alias(name)
    )
