"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

The fingerprints of a template are the minima of all windows over the hashes of its
word triples; a text that shares ``WINDOW + GRAM - 1`` words in a row with it shares a
fingerprint. Shared fingerprints on near diagonals are one candidate, and the
template is aligned with the words around it within a band of those diagonals.

Licenses and their versions differ in few words, so the base has them side by side
and the nearest template wins; and a notice counts only if the words that tell it
from others (its version; of a line, its name as well) stand in the text.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from corpusq.llm.license_texts import MORE_TEMPLATES
from corpusq.llm.texts import PLAIN_WORD, Lookup, PlainHashes, flat_map_texts, shingles

GRAM, WINDOW = 3, 3
BAND = 8
MIN_COVERAGE = 0.7
# Templates that a task holds at a time; more are taken in turns for every few million characters.
TEMPLATES_PER_PASS = 2000
# Words of a line, and of a notice.
LINE, NOTICE = 14, 60
#: Words of a line that do not tell one license from another.
STOCK = frozenset("licensed released distributed available under the terms of this work is a an by and or with software program project code license licence licenses version v spdx identifier https http org www public general".split())

MATCH, MISMATCH, GAP = 2, -1, -1
# Words of the pairs that are aligned together, unless it is one pair.
ALIGN_CELLS = 2_000_000
_ONE = 1 << 32

#: Notices and texts of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    *MORE_TEMPLATES,
)

SCHEMA = "license string, template int, coverage double, matched_words bigint, template_words bigint, start bigint, end bigint"


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    matched: int
    words: int
    first: int  # words of the text, both inclusive
    last: int

    @property
    def coverage(self) -> float:
        return self.matched / self.words


@dataclass(frozen=True)
class Candidate:
    template: int
    low: int  # band of diagonals
    high: int
    most: int  # words that an alignment can match at most
    words: int


def winnowed(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the minima of all windows, of equal ones the last. Fewer grams than a window are one window."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], 1))


class Index:
    """The inverted index: for each fingerprint the templates and places that have it."""

    def __init__(self, templates: list[tuple[int, str, str]]):
        hashes = PlainHashes()
        self.names, self.words, self.needed, places = [], [], [], defaultdict(list)
        whole = set()
        for number, name, text in templates:
            words = hashes.of_text(text)
            grams = shingles(words, GRAM) if len(words) >= GRAM else np.zeros(0, np.uint64)
            chosen = winnowed(grams)
            if len(grams) < WINDOW:
                chosen = np.arange(len(grams))
                whole.update(grams.tolist())
            if len(words) > NOTICE:
                # What a long text says in several places does not show where it is.
                times = Counter(grams.tolist())
                chosen = [at for at in chosen if times[int(grams[at])] == 1]
            for at in chosen:
                places[int(grams[at])].append((len(self.names), int(at)))
            self.names.append((number, name))
            self.words.append(words)
            self.needed.append(_needed(text, hashes))
        self.lookup = Lookup(np.array(list(places), np.uint64)) if places else None
        lists = [places[int(k)] for k in self.lookup.keys] if places else []
        self.ends = np.cumsum([0, *map(len, lists)])
        self.at_template, self.at_place = np.array([x for one in lists for x in one], np.int64).reshape(-1, 2).T
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words, *self.needed]))
        number = lambda words: np.searchsorted(self.vocabulary, words)
        self.counts = [np.unique(number(w), return_counts=True) for w in self.words]
        self.needed_ids = [number(w).tolist() for w in self.needed]
        self.telling = np.zeros(len(self.vocabulary), bool)
        self.telling[[k for ids in self.needed_ids for k in ids]] = True
        #: By key: whether it belongs to a template shorter than a window, of which all grams count.
        self.whole = np.array([int(k) in whole for k in self.lookup.keys] if places else [], bool)

    def matches(self, words: np.ndarray, min_coverage: float) -> list[Match]:
        """All matches, overlapping ones as well."""
        return self.all_matches([words], min_coverage)[0]

    def all_matches(self, texts: list[np.ndarray], min_coverage: float) -> list[list[Match]]:
        """The matches of many texts, overlapping ones as well, whose candidates are aligned together."""
        return self._aligned(texts, [self._candidates(words, min_coverage) for words in texts], min_coverage)

    def nearest(self, texts: list[np.ndarray], min_coverage: float) -> list[list[Match]]:
        """Matches that hold the nearest ones of each text; those that are sure to overlap a nearer one may be left out.

        What a candidate shares with the words around it bounds how near it can come. So the most promising candidate
        of a text is aligned first, then those that could be nearer. If one is as near as any
        can be, it stays, and whatever must overlap it need not be aligned.
        """
        open_ = [sorted(self._candidates(words, min_coverage), key=_promise) for words in texts]
        first = self._aligned(texts, [c[:1] for c in open_], min_coverage)
        rivals, rest = [], []
        for candidates, found in zip(open_, first):
            limit = min(map(_distance, found), default=None)
            near = [c for c in candidates[1:] if limit is not None and _promise(c) <= limit]
            rivals.append(near)
            rest.append(candidates[1 + len(near) :])
        second = self._aligned(texts, rivals, min_coverage)
        found = [a + b for a, b in zip(first, second)]
        for k, matches in enumerate(found):
            if matches:
                m = min(matches, key=_order)
                rest[k] = [c for c in rest[k] if not _must_overlap(c, m, min_coverage)]
        return [a + b for a, b in zip(found, self._aligned(texts, rest, min_coverage))]

    def _aligned(self, texts: list[np.ndarray], candidates: list[list[Candidate]], min_coverage: float) -> list[list[Match]]:
        aligned = iter(align_all([(self.words[c.template], words, c.low, c.high) for words, some in zip(texts, candidates) for c in some]))
        found: list[list[Match]] = [[] for _ in texts]
        for k, some in enumerate(candidates):
            for c, (matched, first, last) in zip(some, aligned):
                if matched >= min_coverage * c.words and np.isin(self.needed[c.template], texts[k][first : last + 1]).all():
                    number, name = self.names[c.template]
                    found[k].append(Match(name, number, matched, c.words, first, last))
        return found

    def _candidates(self, words: np.ndarray, min_coverage: float) -> list[Candidate]:
        """Templates with the bands of diagonals in which enough of their words occur."""
        if self.lookup is None or len(words) < GRAM:
            return []
        grams = shingles(words, GRAM)
        at, key = self.lookup.hits(grams)
        if len(at) == 0:
            return []
        chosen = np.zeros(len(grams), bool)
        chosen[winnowed(grams)] = True
        chosen = chosen[at] | self.whole[key]
        at, key = at[chosen], key[chosen]
        times = self.ends[key + 1] - self.ends[key]
        seed = np.repeat(self.ends[key + 1] - np.cumsum(times), times) + np.arange(times.sum())
        place = np.repeat(at, times)
        template, diagonal = self.at_template[seed], place - self.at_place[seed]
        order = np.lexsort((diagonal, place, template))
        template, place, diagonal = template[order], place[order], diagonal[order]
        cuts = np.flatnonzero(np.diff(template, prepend=-1))
        there = _Places(words, self.vocabulary, self.telling)
        found = []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(template)]):
            t = int(template[a])
            size = len(self.words[t])
            if there.has(self.needed_ids[t], 0, len(words)) and there.shared(*self.counts[t], 0, len(words)) >= min_coverage * size:
                for low, high in _diagonals(place[a:b], diagonal[a:b], size):
                    first, end = max(0, low), max(0, high + size)
                    if there.has(self.needed_ids[t], first, end):
                        most = there.shared(*self.counts[t], first, end)
                        if most >= min_coverage * size:
                            found.append(Candidate(t, low, high, most, size))
        return found


class _Places:
    """Where a text has the words of the index."""

    def __init__(self, words: np.ndarray, vocabulary: np.ndarray, telling: np.ndarray):
        self.n = len(words) + 1
        ids = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
        known = np.flatnonzero(vocabulary[ids] == words)
        self.sorted = np.sort(ids[known] * self.n + known)
        self.tell = defaultdict(list)
        for at in known[telling[ids[known]]].tolist():
            self.tell[int(ids[at])].append(at)

    def has(self, needed: list[int], a: int, b: int) -> bool:
        """Whether the text has all these telling words between two places."""
        for word in needed:
            places = self.tell.get(word)
            if places is None:
                return False
            k = bisect.bisect_left(places, a)
            if k == len(places) or places[k] >= b:
                return False
        return True

    def shared(self, ids: np.ndarray, wanted: np.ndarray, a: int, b: int) -> int:
        """Words in common with a bag of words between two places; no alignment matches more."""
        base = ids * self.n
        times = np.searchsorted(self.sorted, base + min(b, self.n - 1)) - np.searchsorted(self.sorted, base + a)
        return int(np.minimum(times, wanted).sum())


def _needed(text: str, hashes: PlainHashes) -> np.ndarray:
    """The words without which a notice is another one: its numbers, and in a line all but the stock words."""
    words = [w.lower() for w in PLAIN_WORD.findall(text)]
    if len(words) > NOTICE:
        return hashes.of([])
    tell = [w for w in words if any(c.isdigit() for c in w) or (len(words) <= LINE and w not in STOCK)]
    return hashes.of(tell)


def _diagonals(places: np.ndarray, diagonals: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The band of diagonals of each candidate, from seeds by place and diagonal; seeds of others may lie between those of one."""
    low, high = int(diagonals.min()), int(diagonals.max())
    if high - low <= BAND and places[-1] - places[0] <= size + BAND:
        return [(low - BAND, high + BAND)]
    done, running = [], []
    for place, diagonal in zip(places.tolist(), diagonals.tolist()):
        still = []
        for group in running:
            (still if place - group[0] <= size + BAND else done).append(group)
        running = still
        near = [g for g in running if abs(diagonal - g[3]) <= BAND]
        if near:
            group = min(near, key=lambda g: abs(diagonal - g[3]))
            group[1:] = min(group[1], diagonal), max(group[2], diagonal), diagonal
        else:
            running.append([place, diagonal, diagonal, diagonal])
    return sorted({(low - BAND, high + BAND) for _, low, high, _ in done + running})


def align(template: np.ndarray, words: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment of the template with the words on diagonals ``low`` to ``high`` (place in text - place in template).

    Returns matched words, and the first and last word of the text that match.
    """
    return align_all([(template, words, low, high)])[0]


def align_all(pairs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> list[tuple[int, int, int]]:
    """As ``align`` for each pair; pairs of about the same size are aligned together, a template word of all of them at a time."""
    found: list[tuple[int, int, int]] = [(0, -1, -1)] * len(pairs)
    size = lambda k: (pairs[k][3] - pairs[k][2] + 1, len(pairs[k][0]))
    # Bands of nearly one width first, then templates of nearly one length.
    order = sorted(range(len(pairs)), key=lambda k: (size(k)[0] // BAND, size(k)[1]))
    start = 0
    while start < len(order):
        band, length = size(order[start])[0] // BAND, size(order[start])[1]
        end = start + 1
        while end < len(order) and size(order[end])[0] // BAND == band and size(order[end])[1] <= 1.25 * length + BAND:
            if (end + 1 - start) * (size(order[end])[1] + BAND * (band + 1)) > ALIGN_CELLS:
                break
            end += 1
        group = order[start:end]
        for k, one in zip(group, _align_group([pairs[k] for k in group])):
            found[k] = one
        start = end
    return found


def _align_group(pairs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> list[tuple[int, int, int]]:
    """Rows of cells, one a pair and one column a diagonal, go down the templates.

    A cell holds its score, and the matched words (upper half) with the first of
    them (lower half). Ties go to the diagonal step, then to leaving out a word of
    the template. Beyond the ends stand words that match nothing: cells there cost
    and gain nothing, so they are never the best.
    """
    n = len(pairs)
    widths = np.array([high - low + 1 for _, _, low, high in pairs])
    wide, long = int(widths.max()), max(len(t) for t, _, _, _ in pairs)
    template, text = np.zeros((n, long), np.int64), np.full((n, long + wide), -1, np.int64)
    for k, (t, words, low, high) in enumerate(pairs):
        # Small numbers instead of hashes: 0 behind the template, -1 outside of the text, -2 words that it does not have.
        vocabulary, template[k, : len(t)] = np.unique(t, return_inverse=True)
        template[k, : len(t)] += 1
        around = np.asarray(words[max(0, low) : max(0, high + len(t))], vocabulary.dtype)
        where = np.minimum(np.searchsorted(vocabulary, around), len(vocabulary) - 1)
        begin = max(0, -low)
        text[k, begin : begin + len(around)] = np.where(vocabulary[where] == around, where + 1, -2)
    columns = np.arange(wide)
    inside = columns < widths[:, None]
    ragged = not inside.all()
    shift = max(1, int(wide).bit_length())
    score, held = np.zeros((n, wide + 1), np.int64), np.zeros((n, wide + 1), np.int64)
    best, best_held, best_last = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
    pair = np.arange(n)
    for i in range(long):
        same = text[:, i : i + wide] == template[:, i, None]
        here = score[:, :-1] + np.where(same, MATCH, MISMATCH)
        before = held[:, :-1]
        kept = np.where(same, np.where(before == 0, _ONE | (columns + i), before + _ONE), before)
        skip = score[:, 1:] + GAP
        np.copyto(kept, held[:, 1:], where=skip > here)
        here = np.maximum(here, skip)
        np.copyto(kept, 0, where=here <= 0)
        here = np.maximum(here, 0)
        if ragged:
            here *= inside
            kept *= inside
        # Leaving out words of the text: the cell to the left that is best after its cost, of equal ones the nearest.
        source = np.maximum.accumulate(((here - GAP * columns) << shift) | columns, axis=1)
        here = (source >> shift) + GAP * columns
        kept = np.take_along_axis(kept, source & ((1 << shift) - 1), 1)
        if ragged:
            here *= inside
            kept *= inside
        score[:, :-1], held[:, :-1] = here, kept
        rank = (here << 32) | (kept >> 32)
        at = rank.argmax(1)
        top = rank[pair, at]
        better = top > best
        if better.any():
            best[better], best_held[better], best_last[better] = top[better], kept[pair, at][better], (at + i)[better]
    out = []
    for (_, _, low, _), b, h, last in zip(pairs, best.tolist(), best_held.tolist(), best_last.tolist()):
        out.append((b & 0xFFFFFFFF, low + (h & 0xFFFFFFFF), low + last) if b else (0, -1, -1))
    return out


def _distance(m: Match) -> int:
    """How near a match is, lower is nearer: the most matched words less half of the missing ones."""
    return m.words - 3 * m.matched


def _promise(c: Candidate) -> int:
    return c.words - 3 * c.most


def _order(m: Match) -> tuple:
    """The nearest first, then by coverage, then the earliest template."""
    return _distance(m), -m.coverage, m.template, m.first


def _must_overlap(c: Candidate, m: Match, min_coverage: float) -> bool:
    """Whether a match of the candidate cannot lie before or behind ``m``, as there is no room for its words in the band."""
    least = min_coverage * c.words
    return m.first - max(0, c.low) < least and c.high + c.words - 1 - m.last < least


def _best(found: list[Match]) -> list[Match]:
    """Of matches that overlap, the nearest."""
    kept: list[Match] = []
    for m in sorted(found, key=_order):
        if all(m.last < k.first or k.last < m.first for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m.first)


def scan_licenses(docs: DataFrame, keep: list[str], templates: tuple[tuple[str, str], ...] = TEMPLATES, min_coverage: float = MIN_COVERAGE, text: str = "text") -> DataFrame:
    """One row per license found: its template, coverage and span (code points, end exclusive) in the whole text.

    Texts without a match, null and empty ones give no rows; repeated rows give theirs each.
    """
    numbered = [(k, name, body) for k, (name, body) in enumerate(templates)]
    passes = [numbered[k : k + TEMPLATES_PER_PASS] for k in range(0, len(numbered), TEMPLATES_PER_PASS)]

    def make():
        only, hashes = Index(passes[0]) if len(passes) == 1 else None, PlainHashes()

        def work(texts):
            matches = [[] for _ in texts]
            for part in passes:
                index = only or Index(part)
                for k, found_here in enumerate((index.nearest if only else index.all_matches)([hashes.of_text(t) for t in texts], min_coverage)):
                    matches[k] += found_here
            at, found, places = [], [], []
            for k, t in enumerate(texts):
                for m in _best(matches[k]):
                    spans = [x.span() for x in PLAIN_WORD.finditer(t)] if not (at and at[-1] == k) else spans
                    at.append(k)
                    found.append(m)
                    places.append((spans[m.first][0], spans[m.last][1]))
            hashes.trim()
            return at, {
                "license": [m.license for m in found], "template": [m.template for m in found], "coverage": [m.coverage for m in found],
                "matched_words": [m.matched for m in found], "template_words": [m.words for m in found],
                "start": [a for a, _ in places], "end": [b for _, b in places],
            }

        return work

    return flat_map_texts(docs, keep, make, SCHEMA, text)
