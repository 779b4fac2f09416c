"""Periodic runs: stretches of words that repeat with a short period, found by a dictionary of basic factors.

The dictionary names every stretch of 1, 2, 4, 8 ... words so that equal stretches
of a text have equal names. Where a stretch comes again within twice its length, and once
more at the same distance, the distance is proposed as a period. A run of period q
and at least 4q words holds such a progression of stretches of q to 2q words, and the
next occurrence of those is exactly q words on; so every run is proposed. Proposals are
extended word by word to both sides, and equal runs are kept once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusq.llm.texts import _calls, arrow_type, share_code

WORD = re.compile("[^\x20\x09-\x0d]+")

SCHEMA = "n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"


@dataclass(frozen=True)
class Limits:
    """A run has at least ``words`` words and ``times`` its period; four times are the least that the method is sure to find."""

    words: int = 6
    times: int = 4

    def __post_init__(self):
        if self.times < 4:
            raise ValueError("progressions of basic factors find runs of four periods or more")


def periodic_runs(docs: DataFrame, keep: list[str], limits: Limits = Limits(), text: str = "text", tile: Column | None = None) -> DataFrame:
    """All maximal runs of every whole text and the text with each run cut to its first period, one row per input row.

    ``starts``, ``lengths`` and ``periods`` (in words, by start, then period) are parallel
    lists; ``collapsed`` joins the words left by one space. ``tile`` is a number g for
    rows whose n words are first made periodic, null for others: word i >= a becomes word
    a + (i - a) % p with a = g % n and p = 1 + (n - a) // (3 + g % 8).

    A null or empty text has no words, no runs and an empty ``collapsed``. Rows stay as often as
    they occur, equal texts with equal results; an empty table gives no rows. A kept column named like a new one gives
    way. A task holds one call's texts, about 4 million characters or one longer text.
    """
    share_code(docs.sparkSession)
    added = StructType.fromDDL(SCHEMA)
    keep = [c for c in keep if c not in added.names]
    tiles = F.lit(None).cast("bigint") if tile is None else tile.cast("bigint")
    rows = docs.select(*keep, tiles.alias("__tile"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = StructType(rows.schema.fields[: len(keep)] + added.fields)
    types = {f.name: arrow_type(f.dataType.simpleString()) for f in added.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _calls(batch):
                words = [tiled(WORD.findall(t), g) for t, g in zip(texts, part.column(len(keep)).to_pylist(), strict=True)]
                found = collapse(words, find_runs(words, limits))
                arrays = [part.column(k) for k in range(len(keep))]
                arrays += [pa.array(found[n], type=t) for n, t in types.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *types])

    return rows.mapInArrow(run, out)


def tiled(words: list[str], g: int | None) -> list[str]:
    """The words, from word a = g % n on repeated with a period given by g; as they are without g."""
    n = len(words)
    if g is None or n == 0:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapse(words: list[list[str]], runs: list[np.ndarray]) -> dict[str, list]:
    """The columns of ``SCHEMA``: a word goes if it lies in a run after the first period."""
    left = []
    for one, found in zip(words, runs, strict=True):
        if len(found):
            depth = np.zeros(len(one) + 1, np.int64)
            np.add.at(depth, found[:, 0] + found[:, 2], 1)
            np.add.at(depth, found[:, 0] + found[:, 1], -1)
            one = [one[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
        left.append(" ".join(one))
    start, length, period = ([r[:, k] for r in runs] for k in range(3))
    return {"n_words": [len(w) for w in words], "starts": start, "lengths": length, "periods": period, "collapsed": left}


def find_runs(texts: list[list[str]], limits: Limits = Limits()) -> list[np.ndarray]:
    """The maximal runs of each list of words as rows (start, length, period)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    words = _numbered(texts, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    at, period = _proposed(words, owner)
    runs: list[set] = [set() for _ in texts]
    order = np.lexsort((at, period, owner[at]))
    at, period, who = at[order], period[order], owner[at[order]]
    edges = np.flatnonzero(np.diff(who) | np.diff(period)) + 1 if len(at) else []
    for places in np.split(np.arange(len(at)), edges) if len(at) else []:
        t, p = int(who[places[0]]), int(period[places[0]])
        first = int(ends[t] - sizes[t])
        for start, stop in _extended(words[first : ends[t]], at[places] - first, p):
            if stop - start >= max(limits.words, limits.times * p):
                runs[t].add((start, p, stop - start))
    return [np.array([(s, n, p) for s, p, n in sorted(r)], np.int64).reshape(-1, 3) for r in runs]


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def _numbered(texts: list[list[str]], n: int) -> np.ndarray:
    numbers = _Numbers()
    return np.fromiter((numbers[w] for one in texts for w in one), np.int64, n)


def _proposed(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods proposed by all levels of the dictionary; of neighbouring places with one period the first.

    Only factors that occur twice in their text go on to the next level, for a
    longer factor that comes again begins with one.
    """
    n = len(words)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none, none
    places, periods = [], []
    here, length = np.arange(n), 1
    factor = owner * (int(words.max()) + 1) + words
    step, name = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    while len(here):
        order = np.argsort(factor, kind="stable")
        place, factor = here[order], factor[order]
        again = factor[1:] == factor[:-1]
        distance = place[1:] - place[:-1]
        near = again & (distance <= 2 * length)
        at, gap = place[:-1][near], distance[near]
        step[at] = gap
        series = step[at + gap] == gap
        step[at] = 0
        by_place = np.argsort(at[series])
        at, gap = at[series][by_place], gap[series][by_place]
        first = np.ones(len(at), bool)
        first[1:] = (np.diff(at) != 1) | (np.diff(gap) != 0)
        places.append(at[first])
        periods.append(gap[first])
        twice = np.zeros(len(place), bool)
        twice[1:] |= again
        twice[:-1] |= again
        numbers = np.cumsum(np.concatenate(([False], ~again)))
        here = np.sort(place[twice])
        name[place[twice]] = numbers[twice]
        longer = here[here + length < n]
        longer = longer[(name[longer + length] >= 0) & (owner[longer + length] == owner[longer])]
        factor = name[longer] * len(place) + name[longer + length]
        name[here] = -1
        here, length = longer, 2 * length
    return np.concatenate(places), np.concatenate(periods)


def _extended(words: np.ndarray, at: np.ndarray, period: int) -> set[tuple[int, int]]:
    """(start, end) of the longest stretches of this period around each place."""
    breaks = np.flatnonzero(words[:-period] != words[period:])
    k = np.searchsorted(breaks, at)
    edge = np.concatenate(([-1], breaks, [len(words) - period]))
    # No word within [start, end - period) differs from the one a period on.
    return set(zip((edge[k] + 1).tolist(), (edge[k + 1] + period).tolist(), strict=True))
