"""Best-fit packing with certificates.

Pieces are dealt to partitions of bounded size and packed by best-fit
decreasing. Dual feasible functions give each partition a lower bound on its
number of bins; a partition that meets it is certified optimal. What is not
proven full goes on: partitions with a gap hand their unfilled bins, the others
their emptiest one, to a pool that is dealt anew and packed again, as long as
that saves bins; a deal that saves none is followed by one more.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusq.sources.storage import materialize

# Pieces of a partition: what one task holds and sorts at a time.
PER_PARTITION = 4096

# So many deals in a row that save nothing end the exchange.
IDLE_DEALS = 2

ADDED = ("sequence_id", "offset", "sequence_fill", "partition_bins", "partition_bound", "__part", "__bin", "__least", "__open")
_BINS = 2**20


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The least number of bins that any packing needs, by the best of two families of dual feasible functions.

    The first counts items over capacity - e as full and drops those under e; the
    second rounds each size to multiples of 1/k. The plain sum is the case e = 0.
    """
    if len(lengths) == 0:
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * sizes)
    e = np.arange(0, capacity // 2 + 1)
    over = number[-1] - number[capacity - e]
    below = np.where(e > 0, total[np.maximum(e - 1, 0)], 0)
    best = int((-(-(over * capacity + total[capacity - e] - below) // capacity)).max())
    for k in range(1, 21):
        grown = (k + 1) * sizes
        # Values times capacity * k, so that all is whole numbers.
        value = np.where(grown % capacity == 0, sizes * k, grown // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin. Ties go by position."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has exactly r left
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = mask >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = free[left].pop()
            if not free[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(fill)
            fill.append(0)
        bins[item], offsets[item] = b, fill[b]
        fill[b] += size
        left -= size
        if left:
            free[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def pack(pieces: DataFrame, capacity: int, length: str = "length", per_partition: int = PER_PARTITION, rounds: int | None = None) -> DataFrame:
    """Rows of ``pieces`` with their sequence and place.

    Adds sequence_id, offset (gapless from 0 in a sequence), sequence_fill, and
    the certificate of the partition a sequence was made in: partition_bins,
    partition_bound (equal: proven optimal). Lengths must be 1 to ``capacity``;
    rows without a length are an error. ``rounds`` bounds the exchange; without it
    deals go on as long as they save bins. Repeated rows are packed each; an empty
    table gives no rows. Columns of the names that are added give way to them.
    """
    pieces = materialize(pieces.drop(*(c for c in ADDED if c != length)), "pieces")
    n = pieces.count()
    schema = StructType([f for f in pieces.schema.fields]).add("__part", "long").add("__bin", "long").add("offset", "long")
    schema = schema.add("sequence_fill", "long").add("partition_bins", "long").add("partition_bound", "long")
    names = [f.name for f in schema.fields]

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows[length].to_numpy(np.int64)
        if sizes.min() < 1 or sizes.max() > capacity:
            raise ValueError(f"lengths must be 1 to {capacity}")
        bins, offsets, fill = best_fit(sizes, capacity)
        made = {"__bin": bins, "offset": offsets, "sequence_fill": fill[bins]}
        return rows.assign(**made, partition_bins=len(fill), partition_bound=lower_bound(sizes, capacity))[names]

    def deal(rows: DataFrame, size: int, round_: int) -> DataFrame:
        """Numbers by file position, so that repeated rows are spread like any others."""
        parts = max(1, -(-size // per_partition))
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_)), F.lit(parts)) + round_ * 10**8
        return rows.withColumn("__part", part.cast("long")).groupBy("__part").applyInPandas(one, schema)

    packed = materialize(deal(pieces, n, 0), "packed")
    round_ = idle = 0
    while idle < IDLE_DEALS and round_ != rounds:
        round_ += 1
        least = packed.groupBy("__part").agg(F.min(F.struct("sequence_fill", "__bin"))["__bin"].alias("__least"))
        marked = packed.join(least, "__part").withColumn(
            "__open", (F.col("sequence_fill") < capacity)
            & ((F.col("partition_bins") > F.col("partition_bound")) | (F.col("__bin") == F.col("__least"))),
        )
        size, bins = marked.where("__open").agg(F.count("*"), F.count_distinct("__part", "__bin")).first()
        if bins < 2:
            break
        pool = materialize(marked.where("__open").select(pieces.columns), "pool")
        again = materialize(deal(pool, size, round_), "packed")
        if again.agg(F.count_distinct("__part", "__bin")).first()[0] >= bins:
            idle += 1
            continue
        idle = 0
        packed = materialize(marked.where("not __open").select(names).unionByName(again), "packed")
    sequence = (F.col("__part") * _BINS + F.col("__bin")).alias("sequence_id")
    return packed.select(*pieces.columns, sequence, "offset", "sequence_fill", "partition_bins", "partition_bound")
