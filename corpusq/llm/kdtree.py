"""Sharding by a k-d tree over document metadata, near equal in bytes.

A node of the tree that still holds several shards is split at the weighted
quantile of its widest dimension, until every leaf is one shard. All nodes of a
level are split together: one pass finds their extents, three more narrow down the
cuts, each by sums over at most 16,384 ranges a node. What comes back to the driver
are the cuts, one row per node. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusq.sources.storage import materialize

# Copies of a text stay together unless they hold more than this share of a shard's bytes or rows.
MOST_OF_SHARD = 0.02

_STEP_BITS, _STEPS, _TIE_BITS = 14, 3, 20
_AXIS = 2 ** (_STEP_BITS * _STEPS - _TIE_BITS) - 1
_BUCKET_ROWS = 50_000


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _category(name: str) -> Column:
    return F.when(F.col(name).isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(2**20))).cast("double")


def kd_shards(docs: DataFrame, shards: int, id_: str = "doc_id", text: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``id_``, size, text_crc32, shard (0 to shards - 1) and slot (gapless from 0), one row per input row.

    Dimensions: size, id, and the hashed ``categories``; a missing value counts as
    0. A point is a distinct text with the smallest metadata of its copies. Copies
    that hold over 2 percent of a shard (of its bytes or its rows; there are at most
    ``100 * shards`` such texts) are dealt out by id as several points. Ties on a
    dimension are cut by the hash of the text, so equal extents are no obstacle.
    Null texts count as empty. Repeated rows are kept, each with its own slot. An empty table gives no rows.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    dims = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c == id_ else _category(c) for c in (id_, *categories)]
    rows = docs.select(
        F.col(id_).alias("id"), text_bytes(text).alias("size"), F.crc32(raw.cast("binary")).alias("crc"), F.xxhash64(raw).alias("hash"),
        *[d.alias(f"d{k}") for k, d in enumerate(dims, 1)],
    )
    rows = materialize(rows, "kd_rows")
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    text_key = ["hash", "crc", "size"]
    if not n:
        return _result(rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")), id_)
    most_bytes, most_rows = total / shards * MOST_OF_SHARD, n / shards * MOST_OF_SHARD
    hot = (
        rows.groupBy(text_key).agg(F.count("*").alias("n"))
        .withColumn("parts", F.greatest(F.ceil(F.col("n") * F.col("size") / most_bytes), F.ceil(F.col("n") / most_rows)))
        .where("parts > 1 and n > 1").select(*text_key, "parts")
    )
    hot = F.broadcast(materialize(hot, "kd_hot"))
    # Copies of one id and metadata are dealt out too, by the place of their row in the written table.
    deal = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1)))
    keyed = rows.join(hot, text_key, "left").withColumn("sub", deal).drop("parts")
    keyed = materialize(keyed, "kd_keyed")
    key = [*text_key, "sub"]
    axes = [F.col("size").cast("double"), *[F.min(f"d{k}") for k in range(1, len(dims) + 1)]]
    points = keyed.groupBy(key).agg(F.sum("size").alias("weight"), F.array(*axes).alias("dims"))
    points = points.withColumn("tie", F.pmod(F.xxhash64(*key), F.lit(2**_TIE_BITS))).withColumn("node", F.lit(1).cast("long"))
    points = materialize(points, "kd_points")
    leaves = _grow(points, shards, len(dims) + 1)
    placed = keyed.join(leaves, key)
    return _result(_slots(placed, n, shards), id_)


def _grow(points: DataFrame, shards: int, width: int) -> DataFrame:
    """The points' keys with their shard. Node k of a level holds shares[k] shards, the first of them firsts[k]."""
    spark = points.sparkSession
    shares, firsts, extent = {1: shards}, {1: 0}, None
    while any(s > 1 for s in shares.values()):
        stats = points.groupBy("node").agg(
            F.sum("weight").alias("weight"), *[f(F.col("dims")[k]).alias(f"{name}{k}") for k in range(width) for name, f in (("low", F.min), ("high", F.max))]
        ).collect()
        if extent is None:
            extent = [max(r[f"high{k}"] for r in stats) - min(r[f"low{k}"] for r in stats) for k in range(width)]
        splits = []
        for r in stats:
            if shares[r.node] == 1:
                continue
            spread = [(r[f"high{k}"] - r[f"low{k}"]) / extent[k] if extent[k] else 0.0 for k in range(width)]
            axis = max(range(width), key=lambda k: spread[k])
            reach = r[f"high{axis}"] - r[f"low{axis}"]
            left = shares[r.node] // 2
            splits.append((r.node, axis, float(r[f"low{axis}"]), _AXIS / reach if reach else 0.0, r.weight * left / shares[r.node]))
        split = spark.createDataFrame(splits, "node long, axis int, low double, scale double, goal double")
        place = F.floor((F.element_at("dims", F.col("axis") + 1) - F.col("low")) * F.col("scale"))
        placed = points.join(F.broadcast(split), "node", "left")
        placed = placed.withColumn("place", F.least(place, F.lit(_AXIS)) * 2**_TIE_BITS + F.col("tie"))
        cuts = _cuts(placed, splits)
        cut = F.broadcast(spark.createDataFrame([(k, v) for k, v in cuts.items()], "node long, cut long"))
        below = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + (F.col("place") > F.col("cut")).cast("long"))
        points = materialize(placed.join(cut, "node", "left").withColumn("node", below).select(points.columns), "kd_points")
        grown, starts = {}, {}
        for node, share in shares.items():
            if share == 1:
                grown[node], starts[node] = 1, firsts[node]
            else:
                grown[2 * node], starts[2 * node] = share // 2, firsts[node]
                grown[2 * node + 1], starts[2 * node + 1] = share - share // 2, firsts[node] + share // 2
        shares, firsts = grown, starts
    shard = F.broadcast(spark.createDataFrame(list(firsts.items()), "node long, shard int"))
    return points.join(shard, "node").select("hash", "crc", "size", "sub", "shard")


def _cuts(placed: DataFrame, splits: list[tuple]) -> dict[int, int]:
    """For each node the place up to which points go left: where the weights in order pass the goal."""
    spark = placed.sparkSession
    state = [(node, 0, goal) for node, _, _, _, goal in splits]
    for step in range(_STEPS):
        shift = _STEP_BITS * (_STEPS - 1 - step)
        known = F.broadcast(spark.createDataFrame(state, "node long, prefix long, left double"))
        inside = placed.select("node", "place", "weight").join(known, "node")
        inside = inside.where(F.shiftright("place", shift + _STEP_BITS) == F.col("prefix"))
        sums = inside.groupBy("node", "left", F.shiftright("place", shift).alias("bin")).agg(F.sum("weight").alias("weight"))
        upto = F.sum("weight").over(Window.partitionBy("node").orderBy("bin"))
        # The first range that reaches what is left of the goal; rounding must not pass the last one.
        last = F.max("bin").over(Window.partitionBy("node"))
        summed = sums.select("node", "bin", "weight", "left", upto.alias("upto"), last.alias("last"))
        reached = summed.where((F.col("upto") >= F.col("left")) | (F.col("bin") == F.col("last")))
        first = reached.groupBy("node").agg(F.min(F.struct("bin", "weight", "left", "upto")).alias("x")).select("node", "x.*").collect()
        state = [(r.node, r.bin, r.left - (r.upto - r.weight)) for r in first]
        ends = {r.node: r.bin if r.left - (r.upto - r.weight) > r.weight / 2 else r.bin - 1 for r in first}
    return ends


def _slots(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """Numbers within shards: rows are numbered in buckets of bounded size, the buckets start where those before them end."""
    buckets = max(16, -(-n // (shards * _BUCKET_ROWS)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "hash", "sub"), F.lit(buckets)))
    sizes = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    starts = sizes.select("shard", "bucket", ahead.alias("ahead"))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "hash"))
    return rows.withColumn("place", place).join(starts, ["shard", "bucket"]).withColumn("slot", F.col("place") - 1 + F.col("ahead"))


def _result(rows: DataFrame, id_: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_), "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot").cast("long"))
