"""The prefix trie of conversations against a plain dictionary of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from corpusq.llm import conversation_trie
from corpusq.llm.conversation_trie import COLUMNS, prefix_trie
from corpusq.llm.parentheses import Parentheses, range_least, range_sums
from corpusq.llm.queries import QUERIES
from corpusq.llm.texts import read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows, grafted):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    if not grafted:
        return own
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - int(math.fmod(c, 100)), [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def brute(rows, grafted):
    convs = rebuilt(rows, grafted)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        kids = [n for n in below if len(n) == len(node) + 1]
        above = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), above, len(ids), len(kids), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_find_close_and_ranges(seed):
    rng = random.Random(seed)
    bits, depth = [1], 1
    while depth:
        up = rng.random() < (0.52 if len(bits) < 3000 else 0.3)
        bits.append(int(up and (depth > 1 or len(bits) < 3000)))
        depth += 1 if bits[-1] else -1
        if depth == 0 and len(bits) < 3000:
            bits[-1], depth = 1, 2
    stack, close = [], {}
    for k, b in enumerate(bits):
        if b:
            stack.append(k)
        else:
            close[stack.pop()] = k
    tree = Parentheses(np.array(bits))
    assert tree.find_close(tree.opens).tolist() == [close[k] for k in sorted(close)]
    first, end = tree.subtrees()
    values = np.array([rng.randint(0, 9) for _ in first])
    assert range_sums(values, first, end).tolist() == [sum(values[a:b]) for a, b in zip(first, end)]
    assert range_least(values, first, end).tolist() == [min(values[a:b]) for a, b in zip(first, end)]
    assert tree.is_leaf.tolist() == [close[k] == k + 1 for k in sorted(close)]


def test_one_node():
    tree = Parentheses(np.array([1, 0]))
    assert tree.find_close(tree.opens).tolist() == [1] and tree.is_leaf.tolist() == [True]


@pytest.mark.parametrize("grafted", [False, True])
@pytest.mark.parametrize("shard_rows", [1_000, 3])
def test_trie_is_the_brute_one(spark, monkeypatch, grafted, shard_rows):
    """With shards of a few chains nearly all nodes are spines, and shards begin and end inside every kind of subtree."""
    monkeypatch.setattr(conversation_trie, "SHARD_ROWS", shard_rows)
    rng = random.Random(7)
    rows = []
    for c in [*range(0, 160), *range(300, 330), -5, -100, 2**40]:
        hot = rng.random() < 0.3
        for k in range(rng.randint(1, 7)):
            text = "hot" if hot else rng.choice(["a", "bé", "𝔘x", "", None])
            rows.append((c, rng.choice([None, k, k]), rng.choice(["user", "assistant", None]) if not hot else "user", text))
    rows += rng.sample(rows, 40) + [(None, 1, "user", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie(docs, grafted)) == brute(rows, grafted)


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SHARD_ROWS", 2)
    rows = [(c, t, "user", f"t{t}" if t < 300 - c else f"{c} {t}") for c in range(6) for t in range(310)]
    assert found(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_ids_of_one_chain_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_BITS", 3)
    rows = [(c, 0, "user", "same") for c in [*range(-40, 40), 9, 2**33]]
    assert found(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_registered_trie(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_parentheses_trie"](spark, SF)) == brute(rows, True)


def test_odd_conversations(spark):
    schema = SCHEMA + ", chain string, ids string, side string, n_convs string"
    rows = [(None, None, None, None), (1, None, None, None), (1, None, None, ""), (2, 0, "user", "x" * 100_000), (2, 0, "user", "x" * 100_000), (3, 0, None, ""), (3, 0, "", None)]
    docs = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], schema)
    for grafted in (False, True):
        assert found(prefix_trie(docs, grafted)) == brute(rows, grafted)
        assert prefix_trie(docs.limit(0), grafted).count() == 0
        assert prefix_trie(docs.where("conv_id is null"), grafted).count() == 0
