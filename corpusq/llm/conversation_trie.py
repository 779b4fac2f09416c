"""The prefix trie of conversations, as balanced parentheses per shard.

A turn is known by a digest of its role and text, a conversation by the chain of its
turns' digests. Equal conversations are put together first; then the different chains are
sorted and dealt out by range, so that a shard holds a stretch of the trie in preorder and
shares with its neighbours only nodes on the paths of its first and last chain: its
spines. A shard encodes its part as parentheses: findclose delimits subtrees, ranks count
members and leaf pairs, cumulative arrays give savings. All nodes off the spines are
then complete. The spines of all shards, two paths a shard, are merged into one tree
of the same encoding, whose nodes carry what hangs beside them.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.parentheses import Parentheses, range_least, range_sums
from corpusq.llm.texts import arrow_type, share_code
from corpusq.operators.joins import fits_broadcast, sized_join
from corpusq.sources.storage import materialize

DIGEST = 16

# Ids of one chain are kept in blocks of so many consecutive numbers, so that no row grows with a hot chain.
BLOCK_BITS = 16

# A shard holds about so many bytes of chains and ids.
SHARD_BYTES = 8 * 2**20
SHARD_ROWS = 1_000

# At most this many first turns of another conversation can be taken over.
GRAFT_GROUP, GRAFT_TURNS = 100, 6

_NO_ID = np.iinfo(np.int64).max

_CHAINS = "conv_id bigint, chain binary, chars binary"
_NODES = (
    "shard bigint, side bigint, depth bigint, digest binary, chars bigint, conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, parent_conv_id bigint, parent_key binary"
)
_MERGED = "key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, grafted: bool = False) -> DataFrame:
    """One row per node of the trie over ``conversations(conv_id, turn, role, text)``.

    A node of depth d stands for a different sequence of first d turns (role, text), the root for none.
    ``conv_id`` is its smallest member, ``parent_conv_id`` that of its parent (root: null),
    ``n_convs`` its members, ``n_children`` and ``n_leaves`` its children and the childless nodes of its subtree,
    ``saved_tokens`` the sum over its subtree of (members - 1) times code points of the last text,
    ``ends_sha256`` the SHA-256 of the ids of members that end here, ascending, comma-joined.

    Turns are ordered by ``turn``, null first, then role and text; null roles and texts are empty. Rows that
    repeat are turns that repeat. Rows without ``conv_id`` belong to no conversation and are left out; an
    empty table has no nodes, not even a root. Other columns are not read, whatever their names.
    With ``grafted``, conversation c is first rebuilt: the first h turns of conversation c - c % 100 (all it has if
    fewer, none if it is not there), then its own turns after its first h, h = crc32(decimal c) % 6;
    it counts even if that leaves no turns. The remainder of a negative c is not positive, as in SQL.

    One conversation is chained by one task, a turn at a time, 20 bytes a turn. A chain with any number of
    conversations is one row per 65,536 consecutive ids; its ids are hashed in order by the shard that
    has the chain, in bounded memory.
    """
    share_code(conversations.sparkSession)
    chains = _chains(conversations, grafted)
    grouped = chains.groupBy("chain", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.any_value("chars").alias("chars"), F.collect_list("conv_id").alias("ids")
    )
    grouped = materialize(grouped, "chains")
    size = F.length("chain") + F.length("chars") + 8 * F.size("ids")
    rows, total = grouped.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    cores = grouped.sparkSession.sparkContext.defaultParallelism
    shards = max(total // SHARD_BYTES + 1, min(rows // SHARD_ROWS + 1, cores))
    dealt = grouped.repartitionByRange(shards, "chain").sortWithinPartitions("chain", "block")
    nodes = materialize(dealt.select("chain", "chars", "ids").mapInArrow(_shard, _NODES), "trie")
    spines = nodes.where("side is not null").select("shard", "side", "depth", "digest", "chars", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    merged = materialize(spines.repartition(1).mapInArrow(_merge, _MERGED), "spines")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    inner = nodes.where("side is null")
    inner = sized_join(inner, above, ["parent_key"], "left", spread="conv_id", small_fits=fits_broadcast(above))
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return inner.select(*COLUMNS).unionByName(merged.select(*COLUMNS))


def _chains(conversations: DataFrame, grafted: bool) -> DataFrame:
    """``(conv_id, chain, chars)``: the digests of a conversation's turns and the code points of their texts, both in order."""
    empty = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    ).where("conv_id is not null")
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    group: Column = F.col("conv_id") - F.col("conv_id") % GRAFT_GROUP if grafted else F.col("conv_id")
    tied = _tied(turns)
    columns = [group.alias("grp"), "conv_id", "turn", "role", digest.alias("digest"), F.length("text").cast("long").alias("chars")]
    if tied is None:
        last, rows = "digest", turns.select(*columns)
    else:
        # Only texts that an order depends on are moved.
        last, rows = "tie", sized_join(turns, tied, ["conv_id"], "left", spread="turn").select(*columns, F.when(F.col("tied"), F.col("text")).alias("tie"))
    # The conversation that others take turns from comes first in its group.
    order = ["grp", F.col("conv_id") != F.col("grp"), "conv_id", F.asc_nulls_first("turn"), "role", last]
    sorted_rows = rows.repartition("grp").sortWithinPartitions(*order).select("grp", "conv_id", "digest", "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _whole_chains(batches, grafted)

    return sorted_rows.mapInArrow(run, _CHAINS)


def _tied(turns: DataFrame) -> DataFrame | None:
    """``(conv_id, tied)`` of the conversations in which different texts share a turn and role; None if there are none."""
    text = F.xxhash64("text")
    same = turns.groupBy("conv_id", "turn", "role").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    found = materialize(same.where("low <> high").select("conv_id").distinct().withColumn("tied", F.lit(True)), "tied_turns")
    return None if found.isEmpty() else found


def _whole_chains(batches: Iterator[pa.RecordBatch], grafted: bool) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from rows sorted by group and conversation."""
    ids, chains, chars, held = [], [], [], 0
    head, head_of = (b"", b""), None
    for group, conv, chain, counts in _conversations(batches):
        if grafted:
            if conv == group:
                head_of, head = group, (chain[: DIGEST * GRAFT_TURNS], counts[: 8 * GRAFT_TURNS])
            own = zlib.crc32(str(conv).encode()) % GRAFT_TURNS
            digests, lengths = head if head_of == group else (b"", b"")
            chain, counts = digests[: DIGEST * own] + chain[DIGEST * own :], lengths[: 8 * own] + counts[8 * own :]
        ids.append(conv)
        chains.append(chain)
        chars.append(counts)
        held += len(chain)
        if len(ids) >= 10_000 or held > 2**22:
            yield _batch(_CHAINS, [ids, chains, chars])
            ids, chains, chars, held = [], [], [], 0
    if ids:
        yield _batch(_CHAINS, [ids, chains, chars])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Group, id, digests and text lengths of each conversation; one may go over several batches."""
    at, digests, lengths = None, [], []
    for batch in batches:
        group, conv = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        digest = b"".join(batch.column(2).to_pylist())
        chars = batch.column(3).to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(conv)) + 1, [len(conv)])).tolist()
        for a, b in itertools.pairwise(edges):
            here = (int(group[a]), int(conv[a])) if b > a else at
            if at is not None and here != at:
                yield *at, b"".join(digests), b"".join(lengths)
                digests, lengths = [], []
            at = here
            digests.append(digest[DIGEST * a : DIGEST * b])
            lengths.append(chars[a:b].tobytes())
    if at is not None:
        yield *at, b"".join(digests), b"".join(lengths)


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    named = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, arrow_type(t)) for v, (_, t) in zip(columns, named, strict=True)], names=[n for n, _ in named])


class _Trie:
    """A trie built from sorted chains: parentheses, and per node its depth, parent, digest, length and own counts."""

    def __init__(self):
        self.bits = bytearray([1])
        self.depth, self.parent = array("q", [0]), array("q", [-1])
        self.digest, self.chars = [b""], array("q", [0])
        # What a node has of itself: members, the smallest of them, and what hangs beside the tree.
        self.members, self.least = array("q", [0]), array("q", [_NO_ID])
        self.kids, self.leaves, self.saved = array("q", [0]), array("q", [0]), array("q", [0])
        self.ends: dict[int, str] = {}
        self.path = [0]
        self.chain = b""

    def add(self, chain: bytes, chars: np.ndarray) -> None:
        """Open the nodes of a chain that is not before the last one; ``path`` then has its node of every depth."""
        shared = _shared(self.chain, chain)
        self.bits += bytes(len(self.path) - 1 - shared)
        del self.path[shared + 1 :]
        for k in range(shared, len(chain) // DIGEST):
            self.bits.append(1)
            self.depth.append(k + 1)
            self.parent.append(self.path[-1])
            self.path.append(len(self.depth) - 1)
            self.digest.append(chain[DIGEST * k : DIGEST * (k + 1)])
            self.chars.append(int(chars[k]))
            self.members.append(0)
            self.least.append(_NO_ID)
            self.kids.append(0)
            self.leaves.append(0)
            self.saved.append(0)
        self.chain = chain

    def finish(self) -> dict[str, np.ndarray]:
        """Counts of all nodes, by preorder number."""
        own = {n: np.frombuffer(getattr(self, n), np.int64) for n in ("depth", "parent", "chars", "members", "least", "kids", "leaves", "saved")}
        tree = Parentheses(np.frombuffer(self.bits + bytes(len(self.path)), np.int8))
        first, end = tree.subtrees()
        n_convs = range_sums(own["members"], first, end)
        inside = np.bincount(own["parent"][1:], minlength=len(first))
        leaf = tree.is_leaf & (own["kids"] == 0)
        saved = own["saved"] + np.maximum(n_convs - 1, 0) * own["chars"]
        return own | {
            "n_convs": n_convs,
            "conv_id": range_least(own["least"], first, end),
            "n_children": own["kids"] + inside,
            "n_leaves": range_sums(leaf + own["leaves"], first, end),
            "saved_tokens": range_sums(saved, first, end),
        }


def _shared(a: bytes, b: bytes) -> int:
    """How many digests two chains begin with in common."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: DIGEST * middle] == b[: DIGEST * middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _keys(digests: list[bytes]) -> list[bytes]:
    """A key for every node of a path, the root first."""
    return list(itertools.accumulate(digests, lambda key, d: hashlib.md5(key + d).digest(), initial=b""))


_EMPTY = hashlib.sha256(b"").hexdigest()


class _Ends:
    """SHA-256 over ascending ids, fed block by block."""

    def __init__(self):
        self.hash, self.some = hashlib.sha256(), False

    def add(self, ids: np.ndarray) -> None:
        text = ",".join(map(str, ids.tolist())).encode()
        self.hash.update(b"," + text if self.some else text)
        self.some = True


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard from its sorted chains: those off the spines complete, those on a spine with what hangs beside it."""
    trie, ends, last, first_path = _Trie(), None, None, None
    for batch in batches:
        for chain, chars, ids in zip(*batch.columns, strict=True):
            chain, ids = chain.as_py(), np.sort(ids.values.to_numpy())
            if chain != last:
                if ends is not None:
                    trie.ends[trie.path[-1]] = ends.hash.hexdigest()
                trie.add(chain, np.frombuffer(chars.as_py(), np.int64))
                first_path = first_path or list(trie.path)
                last, ends = chain, _Ends()
            ends.add(ids)
            node = trie.path[-1]
            trie.members[node] += len(ids)
            trie.least[node] = min(trie.least[node], int(ids[0]))
    if ends is None:
        return
    trie.ends[trie.path[-1]] = ends.hash.hexdigest()
    last_path = list(trie.path)
    found = trie.finish()
    spine = np.zeros(len(trie.depth), bool)
    spine[first_path] = spine[last_path] = True
    yield from _inner_nodes(trie, found, spine, [first_path, last_path])
    yield _spines(trie, found, spine, first_path, last_path)


def _inner_nodes(trie: _Trie, found: dict, spine: np.ndarray, paths: list[list[int]]) -> Iterator[pa.RecordBatch]:
    keys = {n: k for path in paths for n, k in zip(path, _keys([trie.digest[n] for n in path[1:]]), strict=True)}
    inner = np.flatnonzero(~spine)
    for k in range(0, len(inner), 10_000):
        at = inner[k : k + 10_000]
        parent = found["parent"][at]
        below = spine[parent]
        n = len(at)
        yield _batch(
            _NODES,
            [
                [None] * n, [None] * n, found["depth"][at], [None] * n, [None] * n, found["conv_id"][at], found["n_convs"][at], found["n_children"][at],
                found["n_leaves"][at], found["saved_tokens"][at], [trie.ends.get(i, _EMPTY) for i in at.tolist()],
                pa.array(found["conv_id"][parent], pa.int64(), mask=below),
                [keys[p] if b else None for p, b in zip(parent.tolist(), below.tolist(), strict=True)],
            ],
        )


def _spines(trie: _Trie, found: dict, spine: np.ndarray, first: list[int], last: list[int]) -> pa.RecordBatch:
    """A row per node of the first path and of the last; a node of both has its counts in the first."""
    own = {n: found[n].copy() for n in ("members", "least", "kids", "leaves", "saved")}
    top = np.flatnonzero(~spine)
    top = top[spine[found["parent"][top]]]
    above = found["parent"][top]
    np.add.at(own["members"], above, found["n_convs"][top])
    np.minimum.at(own["least"], above, found["conv_id"][top])
    np.add.at(own["kids"], above, 1)
    np.add.at(own["leaves"], above, found["n_leaves"][top])
    np.add.at(own["saved"], above, found["saved_tokens"][top])
    shard, rows, seen = TaskContext.get().partitionId(), [], set()
    for side, path in enumerate([first, last]):
        for i in path:
            one = [0, _NO_ID, 0, 0, 0, None] if i in seen else [*(int(own[n][i]) for n in ("members", "least", "kids", "leaves", "saved")), trie.ends.get(i)]
            members, least, kids, leaves, saved, ends = one
            rows.append([shard, side, trie.depth[i], trie.digest[i], trie.chars[i], least, members, kids, leaves, saved, ends, None, None])
            seen.add(i)
    return _batch(_NODES, [list(c) for c in zip(*rows, strict=True)])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tree of all spines: nodes of several shards add up, and all counts are made anew."""
    tables = list(batches)
    if not any(t.num_rows for t in tables):
        return
    rows = pa.Table.from_batches(tables).sort_by([("shard", "ascending"), ("side", "ascending"), ("depth", "ascending")]).to_pylist()
    paths = [list(path) for _, path in itertools.groupby(rows, lambda r: (r["shard"], r["side"]))]
    trie = _Trie()
    for chain, path in sorted(((b"".join(r["digest"] for r in p), p) for p in paths), key=lambda one: one[0]):
        trie.add(chain, np.array([r["chars"] for r in path[1:]], np.int64))
        for node, r in zip(trie.path, path, strict=True):
            trie.members[node] += r["n_convs"]
            trie.least[node] = min(trie.least[node], r["conv_id"])
            trie.kids[node] += r["n_children"]
            trie.leaves[node] += r["n_leaves"]
            trie.saved[node] += r["saved_tokens"]
            if r["ends_sha256"] is not None:
                trie.ends[node] = r["ends_sha256"]
    found = trie.finish()
    parent, keys = found["parent"], [b""]
    for i in range(1, len(parent)):
        keys.append(hashlib.md5(keys[parent[i]] + trie.digest[i]).digest())
    above = pa.array(found["conv_id"][parent], pa.int64(), mask=parent < 0)
    ends = [trie.ends.get(i, _EMPTY) for i in range(len(parent))]
    yield _batch(_MERGED, [keys, found["conv_id"], found["depth"], above, *(found[n] for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")), ends])
