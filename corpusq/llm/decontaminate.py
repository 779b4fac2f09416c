"""Benchmark decontamination by SimHash over windows as long as the items.

A window is fingerprinted if it shares a shingle with some item (without one its
similarity is 0) and lies on that shingle's diagonal, give or take as many words as
the threshold lets differ. Fingerprints have 128 bits in 8 blocks. Two of them at
most ``RADIUS`` bits apart differ in some block by at most ``RADIUS // 8`` bits, so
looking up the block values that near finds every item within the radius; exact
weighted similarity of the shingles decides.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.texts import PLAIN_WORD, Lookup, PlainHashes, filter_texts, flat_map_texts, mix, shingles

SIZE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 8, 16
RADIUS = 31
# Items of one pass over the documents, and their characters; more are done in several.
ITEMS_PER_PASS = 20_000
CHARS_PER_PASS = 16_000_000
# Fingerprints that are looked up together.
PRINTS = 256

SCHEMA = "item_id bigint, similarity double, distance int, first_word bigint, n_words bigint, start bigint, end bigint"
_SALT = np.uint64(0xA5A5A5A55A5A5A5A)


def fingerprints(grams: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the grams [s, s + size) for every start, as 8 block values each."""
    halves = np.stack((grams, mix(grams ^ _SALT)), 1)
    bits = np.unpackbits(halves.view(np.uint8), axis=1, bitorder="little").astype(np.float64) * 2 - 1
    summed = np.concatenate((np.zeros((1, bits.shape[1])), np.cumsum(bits * weights[:, None], 0)))
    on = (summed[starts + size] - summed[starts]) > 1e-9
    return np.packbits(on, axis=1, bitorder="little").view("<u2")


def shingle_weights(words: list[str], size: int) -> np.ndarray:
    """A shingle weighs as many letters and digits as it has, as long words say more than short ones."""
    ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))))
    width = min(size, len(words))
    return (ends[width:] - ends[: len(ends) - width]).astype(np.float64)


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of shingles, given with their weights."""
    a, b = (_counted(grams) for grams, _ in (left, right))
    weight = dict(zip(left[0].tolist(), left[1].tolist())) | dict(zip(right[0].tolist(), right[1].tolist()))
    low = sum(min(n, b.get(g, 0)) * weight[g] for g, n in a.items())
    high = sum(max(a.get(g, 0), b.get(g, 0)) * weight[g] for g in a.keys() | b.keys())
    return low / high if high else 0.0


def _counted(grams: np.ndarray) -> dict[int, int]:
    values, counts = np.unique(grams, return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


class Items:
    """Items by their shingles and by the blocks of their fingerprints, in flat arrays."""

    def __init__(self, items: list[tuple[int, str]], similar: float):
        hashes = PlainHashes()
        self.similar = similar
        self.ids, self.bags, self.words = [], [], []
        for item_id, text in items:
            words = PLAIN_WORD.findall(text or "")
            if not words:
                continue
            self.ids.append(item_id)
            self.bags.append((shingles(hashes.of(words), SIZE), shingle_weights(words, SIZE)))
            self.words.append(len(words))
            hashes.trim()
        sizes = np.minimum(SIZE, np.array(self.words, np.int64))
        self.by_size: dict[int, tuple] = {}
        # Items under SIZE words have shingles of their own length.
        for size in np.unique(sizes).tolist():
            of = np.flatnonzero(sizes == size)
            grams = np.concatenate([self.bags[k][0] for k in of])
            lengths = np.array([len(self.bags[k][0]) for k in of])
            item = np.repeat(of, lengths).astype(np.int32)
            place = (np.arange(len(grams)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            order = np.argsort(grams, kind="stable")
            lookup = Lookup(grams)
            ends = np.append(np.searchsorted(grams[order], lookup.keys), len(grams))
            self.by_size[size] = lookup, ends, item[order], place[order]
        prints = [fingerprints(grams, weights, np.zeros(1, np.int64), len(grams))[0] for grams, weights in self.bags]
        self.prints = np.array(prints, np.uint16).reshape(-1, BLOCKS)
        # Each item stands once a block, under its own value; the values nearby are listed when a fingerprint is looked up.
        reach = [0] + [sum(1 << b for b in c) for n in range(1, RADIUS // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), n)]
        self.reach = np.array(reach, np.uint16)
        self.blocks = []
        for k in range(BLOCKS):
            order = np.argsort(self.prints[:, k], kind="stable")
            ends = np.searchsorted(self.prints[order, k], np.arange(2**BLOCK_BITS + 1)).astype(np.int32)
            self.blocks.append((ends, order, np.diff(ends) > 0))

    def within(self, print_: np.ndarray) -> list[tuple[int, int]]:
        """All items at most ``RADIUS`` bits away, with their distance."""
        return self.all_within(print_[None])[0]

    def all_within(self, prints: np.ndarray) -> list[list[tuple[int, int]]]:
        """As ``within`` for each fingerprint."""
        found: list[list[tuple[int, int]]] = [[] for _ in prints]
        for start in range(0, len(prints), PRINTS):
            some, pairs = prints[start : start + PRINTS], []
            for k, (ends, items, there) in enumerate(self.blocks):
                values = some[:, k, None] ^ self.reach
                row, col = np.nonzero(there[values])
                value = values[row, col]
                first, times = ends[value], ends[value.astype(np.int64) + 1] - ends[value]
                at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
                pairs.append(np.repeat(row, times) * len(self.ids) + items[at])
            row, item = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.ids)))
            distance = np.bitwise_count(self.prints[item] ^ some[row]).sum(1)
            near = distance <= RADIUS
            for r, i, d in zip(row[near].tolist(), item[near].tolist(), distance[near].tolist()):
                found[start + r].append((i, d))
        return found

    def windows(self, words: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """(words of a shingle, words of a window): starts of the windows to look at."""
        found = defaultdict(set)
        for size, (lookup, ends, items, places) in self.by_size.items():
            if len(words) < size:
                continue
            at, key = lookup.hits(shingles(words, size))
            for p, k in zip(at.tolist(), key.tolist()):
                for item, place in zip(items[ends[k] : ends[k + 1]].tolist(), places[ends[k] : ends[k + 1]].tolist()):
                    wide = self.words[item]
                    slack = int((wide - size + 1) * (1 - self.similar) / (1 + self.similar)) + 1
                    last = max(0, len(words) - wide)
                    for s in range(p - place - slack, p - place + slack + 1):
                        found[size, min(wide, len(words))].add(min(max(s, 0), last))
        return found

    def search(self, words: np.ndarray, text: str) -> dict[int, tuple[float, int, int, int]]:
        """For each item found: similarity, distance, start and words of its best window (the first of equal ones)."""
        best: dict[int, tuple[float, int, int, int]] = {}
        wanted = self.windows(words) if self.ids else {}
        plain = PLAIN_WORD.findall(text) if wanted else []
        for (size, wide), starts in sorted(wanted.items()):
            starts = np.array(sorted(starts))
            grams, weights = shingles(words, size), shingle_weights(plain, size)
            n = wide - size + 1
            # Windows lie together in a few places: only those stretches are summed.
            for group in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
                a, b = group[0], group[-1] + n
                prints = fingerprints(grams[a:b], weights[a:b], group - a, n)
                for start, near in zip(group.tolist(), self.all_within(prints)):
                    for item, distance in near:
                        if min(SIZE, self.words[item]) != size:
                            continue
                        s = similarity((grams[start : start + n], weights[start : start + n]), self.bags[item])
                        id_ = self.ids[item]
                        if s >= self.similar and (id_ not in best or s > best[id_][0]):
                            best[id_] = (s, distance, start, wide)
        return best


def item_passes(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The items in blocks of bounded size, for one pass over the documents each. Items without an id or text are left out."""
    known = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    n, chars = known.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, -(-n // ITEMS_PER_PASS), -(-chars // CHARS_PER_PASS))
    if parts == 1:
        return [[(r.item_id, r.text) for r in known.orderBy("item_id").collect()]]
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    return [[(r.item_id, r.text) for r in known.where(part == k).orderBy("item_id").collect()] for k in range(parts)]


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str], similar: float = SIMILARITY, text: str = "text") -> DataFrame:
    """One row per row of ``docs`` and benchmark item whose best window is at least ``similar``, whatever its place in the whole text.

    Spans are in words and in code points, end exclusive. Null and empty texts have
    none. Items of the same text are reported each.
    """

    def one(items):
        def make():
            index, hashes = Items(items, similar), PlainHashes()

            def work(texts):
                at, rows = [], []
                for k, t in enumerate(texts):
                    found = index.search(hashes.of_text(t), t)
                    if found:
                        spans = [m.span() for m in PLAIN_WORD.finditer(t)]
                        for item, (s, d, start, n) in sorted(found.items()):
                            at.append(k)
                            rows.append((item, s, d, start, n, spans[start][0], spans[start + n - 1][1]))
                hashes.trim()
                return at, {c.split()[0]: [r[j] for r in rows] for j, c in enumerate(SCHEMA.split(", "))}

            return work

        return flat_map_texts(docs, keep, make, SCHEMA, text)

    return reduce(DataFrame.unionAll, [one(items) for items in item_passes(benchmark)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """The documents without a benchmark item, with their own columns."""
    for items in item_passes(benchmark):

        def make(items=items):
            index, hashes = Items(items, similar), PlainHashes()

            def work(texts):
                found = [not index.search(hashes.of_text(t), t) for t in texts]
                hashes.trim()
                return found

            return work

        docs = filter_texts(docs, make)
    return docs
