"""Page statistics: PageRank of the link graph and monthly page views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.operators.joins import sized_join
from corpusq.sources.storage import materialize

# A page with more links than this has them spread over several tasks.
LINKS_PER_SLOT = 100_000

# Rounds between two writes of the ranks: a shuffle each, in a plan that grows by one join a round.
ROUNDS_PER_WRITE = 8


def pagerank(
    links: DataFrame, steps: int = 10, damping: float = 0.85, links_per_slot: int = LINKS_PER_SLOT
) -> DataFrame:
    """``(doc_id, pr)`` after a fixed number of steps over ``links(src, dst)``.

    Repeated links count once. Pages without links of their own give their rank
    to all pages evenly.

    The links are laid out by source once and kept that way, so that a step moves
    ranks and not links. The ranks, a row per page, are written to the shared
    folder after every step: plans stay short, and a lost executor costs at most
    the current step and its share of the laid-out links.
    """
    nodes, slotted, total = _laid_out(links, links_per_slot)
    if total == 0:
        return nodes.select("doc_id", F.lit(None).cast("double").alias("pr"))
    try:
        slotted.count()  # the layout of the kept links is known to the planner from now on
        state = nodes.withColumn("pr", F.lit(1.0 / total))
        for _ in range(steps):
            state = materialize(_step(state, slotted, total, damping), "ranks")
    finally:
        slotted.unpersist()
    return state.select("doc_id", "pr")


def pagerank_to_tolerance(
    links: DataFrame, tolerance: float = 1e-8, damping: float = 0.85, links_per_slot: int = LINKS_PER_SLOT
) -> DataFrame:
    """``(doc_id, pr)`` that differ from the limit of all steps by less than ``tolerance`` in total.

    The limit is in proportion to the solution y of ``y = 1 + damping * (what pages with links send of y)``:
    giving the rank of pages without links to all evenly only changes the factor. Only pages with links send, so
    only links between those are followed in rounds. Each such page keeps what it has of y and a rest that it has
    not sent on yet. In a round pages whose rest is above a limit take it over into y and send it along their
    links. Rests soon shrink by an even rate; what all later rounds would then bring is taken over
    at once, before the next rounds, as long as that leaves less than rounds alone are sure to. The rest is worked out from what
    was taken over, whatever that is, and may be below 0. What is left of
    all rests when none is above the limit bounds the error. In the end all pages get their y from those that link to them.
    """
    edges, nodes = _edges_and_nodes(links, links_per_slot)
    total = nodes.count()
    if total == 0:
        return nodes.select("doc_id", F.lit(None).cast("double").alias("pr"))
    least = tolerance * (1.0 - damping)
    slotted = _slotted(edges, nodes)
    senders = nodes.where("links > 0 and doc_id is not null")
    keys = ["src"] if senders.where("slots > 1").isEmpty() else ["src", "slot"]
    ways = _ways(slotted, senders, keys).persist()
    try:
        ways.count()  # the layout of the kept links is known to the planner from now on
        state = senders.withColumn("y", F.lit(0.0)).withColumn("rest", F.lit(1.0)).withColumn("was", F.lit(0.0))
        left, rate, ahead = None, 0.0, True
        while True:
            most, now, before = state.agg(F.max(F.abs("rest")), F.sum(F.abs("rest")), F.sum(F.abs("was"))).first()
            if most is None or most <= least:
                break
            ahead = ahead and (left is None or rate == 0.0 or now <= left * damping**ROUNDS_PER_WRITE)
            left, rate = now, min(now / before, damping) if ahead and before else 0.0
            for k in range(ROUNDS_PER_WRITE):
                state = _push(state, ways, keys, damping, least, 1.0 / (1.0 - rate) if k == 0 else 1.0)
            state = materialize(state, "ranks")
    finally:
        ways.unpersist()
    received = _received(state, slotted, "y")
    found = nodes.join(received, "doc_id", "left")
    found = materialize(found.select("doc_id", (F.lit(1.0) + F.lit(damping) * F.coalesce("received", F.lit(0.0))).alias("y")), "ranks")
    whole = found.agg(F.sum("y")).first()[0]
    return found.select("doc_id", (F.col("y") / F.lit(whole)).alias("pr"))


def monthly_page_views(views: DataFrame) -> DataFrame:
    """``(doc_id, month, views)`` from ``views(doc_id, ts)``, one row per view."""
    return views.groupBy("doc_id", F.trunc("ts", "month").alias("month")).agg(F.count("*").alias("views"))


def page_views_of(monthly: DataFrame, month: str) -> DataFrame:
    """``(doc_id, views)`` of one month, named as ``yyyy-MM``."""
    return monthly.where(F.col("month") == F.to_date(F.lit(month), "yyyy-MM")).select("doc_id", "views")


def total_page_views(monthly: DataFrame) -> DataFrame:
    """``(doc_id, views)`` over all months."""
    return monthly.groupBy("doc_id").agg(F.sum("views").alias("views"))


def _laid_out(links: DataFrame, links_per_slot: int) -> tuple[DataFrame, DataFrame, int]:
    """Pages, their different links laid out by source and kept, and how many pages there are."""
    edges, nodes = _edges_and_nodes(links, links_per_slot)
    partitions = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes, _slotted(edges, nodes).repartition(partitions, "src", "slot").persist(), nodes.count()


def _edges_and_nodes(links: DataFrame, links_per_slot: int) -> tuple[DataFrame, DataFrame]:
    edges = materialize(links.select("src", "dst").distinct().withColumn("slot", F.lit(0)), "links")
    return edges, _nodes(edges, links_per_slot)


def _nodes(edges: DataFrame, links_per_slot: int) -> DataFrame:
    """``(doc_id, links, slots)``: every page, its links, the tasks they take."""
    ends = edges.select(F.col("src").alias("doc_id"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("dst").alias("doc_id"), F.lit(0).alias("out"))
    )
    degrees = ends.groupBy("doc_id").agg(F.sum("out").alias("links"))
    slots = F.greatest(F.ceil(F.col("links") / links_per_slot), F.lit(1)).cast("int")
    return materialize(degrees.withColumn("slots", slots), "pages")


def _slotted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of pages with very many links are dealt out over the page's slots."""
    busy = nodes.where(F.col("slots") > 1).select(F.col("doc_id").alias("src"), "slots")
    if busy.isEmpty():
        return edges
    # There is at most one such page per slot's worth of links.
    dealt = sized_join(edges, busy, ["src"], "left", spread="dst")
    slot = F.coalesce(F.pmod(F.hash("dst"), F.col("slots")), F.lit(0))
    return materialize(dealt.select("src", "dst", slot.alias("slot")), "links")


def _step(state: DataFrame, slotted: DataFrame, total: int, damping: float) -> DataFrame:
    """One power iteration."""
    idle = state.agg(F.sum(F.when(F.col("links") == 0, F.col("pr")))).first()[0] or 0.0
    received = _received(state.where(F.col("links") > 0), slotted, "pr")
    to_all = (1.0 - damping + damping * idle) / total
    pr = F.lit(to_all) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    return state.drop("pr").join(received, "doc_id", "left").select("doc_id", "links", "slots", pr.alias("pr"))


def _ways(slotted: DataFrame, senders: DataFrame, keys: list[str]) -> DataFrame:
    """``(src, slot, dst, own)``: links between pages with links, and a row of its own from each such page to itself, laid out and sorted by ``keys``."""
    inner = slotted.join(senders.select(F.col("doc_id").alias("dst")), "dst", "left_semi").select("src", "slot", "dst", F.lit(False).alias("own"))
    page = F.col("doc_id")
    own = senders.select(page.alias("src"), F.lit(0).alias("slot"), page.alias("dst"), F.lit(True).alias("own"))
    partitions = int(slotted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return inner.unionByName(own).repartition(partitions, *keys).sortWithinPartitions(*keys)


def _push(state: DataFrame, ways: DataFrame, keys: list[str], damping: float, least: float, times: float = 1.0) -> DataFrame:
    """One round: rests above the limit are taken over, so many times, and sent on. ``was`` is the rest before.

    What a page keeps goes its own way, so that a round reads the state once. It lies by page after the
    round, as the links do by source: the sums are the only shuffle, but for pages with several slots.
    """
    state = state.withColumnRenamed("doc_id", "src")
    if "slot" in keys:
        state = state.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    active, own = F.abs("rest") > least, F.col("own")
    taken = F.when(active, F.lit(times) * F.col("rest")).otherwise(0.0)
    return (
        ways.hint("merge").join(state, keys).where(own | active)
        .groupBy(F.col("dst").alias("doc_id"))
        .agg(
            F.max(F.when(own, F.col("links"))).alias("links"),
            F.max(F.when(own, F.col("slots"))).alias("slots"),
            F.sum(F.when(own, F.col("y") + taken).otherwise(0.0)).alias("y"),
            F.sum(F.when(own, F.col("rest") - taken).otherwise(F.lit(damping) * taken / F.col("links"))).alias("rest"),
            F.max(F.when(own, F.col("rest"))).alias("was"),
        )
    )


def _received(senders: DataFrame, slotted: DataFrame, value: str) -> DataFrame:
    """``(doc_id, received)``: an even share of a page's value along each of its links. Only pages with several slots are repeated."""
    shares = senders.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).select(
        F.col("doc_id").alias("src"), "slot", (F.col(value) / F.col("links")).alias("share")
    )
    return slotted.join(shares, ["src", "slot"]).groupBy(F.col("dst").alias("doc_id")).agg(F.sum("share").alias("received"))
