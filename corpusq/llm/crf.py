"""A linear-chain conditional random field over the words of a line or block, trained and decoded in numpy.

A word ends at blanks and at the marks that a model cuts at, so that values inside
markup are words of their own. A chain is a line, or a stretch of lines that belong together.

The score of a label at a word is what the word's own hashed features say, plus a
term for the class of the word before, one for the class of the word after and
one for the class of the whole text. Word classes come from small closed sets.
So the score of any word has a bound that holds wherever it stands, and texts in
which no word can gain from a label are known to be all outside without decoding.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import xxhash

from corpusq.llm.texts import CACHE_WORDS

OUT = 0
_FORBIDDEN = -1e4


@dataclass(frozen=True)
class Features:
    """What a model looks at: own features of a word (strings), class of a word, class of a text.

    ``labels`` names the tags, ``O`` first, then ``B-x`` and ``I-x``. Word class 0 is kept for the edge of a line.
    """

    labels: tuple[str, ...]
    own: Callable[[str], list[str]]
    word_class: Callable[[str], int]
    word_classes: int
    text_class: Callable[[str], int]
    text_classes: int
    buckets: int = 2**13
    #: What is a word; no word holds a blank.
    word: re.Pattern = re.compile(r"\S+")
    #: Where a text is cut into chains: (start, end) in order, without words outside.
    chains: Callable[[str], list[tuple[int, int]]] | None = None


@dataclass
class Model:
    features: Features
    own: np.ndarray  # buckets x labels
    before: np.ndarray  # word classes x labels
    after: np.ndarray
    text: np.ndarray  # text classes x labels
    move: np.ndarray  # labels x labels
    start: np.ndarray

    def ids(self, own: Iterable[str]) -> list[int]:
        return [xxhash.xxh32_intdigest(f) % self.features.buckets for f in own]


def lines(text: str) -> list[tuple[int, int]]:
    found, at = [], 0
    for line in text.split("\n"):
        found.append((at, at + len(line)))
        at += len(line) + 1
    return found


def marked(line: str, marks: dict[str, str]) -> tuple[str, list[tuple[str, int, int]]]:
    """A labelled line without its marks, and its spans. ``marks`` names the kind of each pair of an opening and a closing mark."""
    opening, closing = {m[0]: kind for m, kind in marks.items()}, {m[1] for m in marks}
    out, spans, start = [], [], (None, 0)
    for c in line:
        if c in opening:
            start = opening[c], len(out)
        elif c in closing:
            spans.append((*start, len(out)))
        else:
            out.append(c)
    return "".join(out), spans


def tagged(text: str, spans: list[tuple[str, int, int]], features: Features) -> tuple[list[str], list[str]]:
    """The words of a labelled text and their tags."""
    words, tags, last = [], [], None
    for m in features.word.finditer(text):
        inside = next((s for s in spans if s[1] < m.end() and m.start() < s[2]), None)
        words.append(m[0])
        tags.append("O" if inside is None else ("I-" if inside is last else "B-") + inside[0])
        last = inside
    return words, tags


def allowed(labels: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Penalties that let I-x follow only B-x and I-x."""
    move, start = np.zeros((len(labels), len(labels))), np.zeros(len(labels))
    for k, name in enumerate(labels):
        if name.startswith("I-"):
            start[k] = _FORBIDDEN
            move[[j for j, other in enumerate(labels) if other[2:] != name[2:]], k] = _FORBIDDEN
    return move, start


def train(rows: list[tuple[list[str], list[str], int]], features: Features, epochs: int = 150, rate: float = 0.05, decay: float = 2e-4) -> Model:
    """Maximum likelihood with Adam over all rows (words, labels, class of their text) at once."""
    labels = {name: k for k, name in enumerate(features.labels)}
    n, wide, states = len(rows), max(len(w) for w, _, _ in rows), len(labels)
    mask_move, mask_start = allowed(features.labels)
    shape = (features.buckets, features.word_classes, features.word_classes, features.text_classes)
    offsets = np.cumsum((0, *shape))
    probe = Model(features, *[np.zeros(0)] * 6)
    ids, cell, gold, length = [], [], np.zeros((n, wide), np.int64), np.zeros(n, np.int64)
    for r, (words, tags, kind) in enumerate(rows):
        length[r] = len(words)
        classes = [0, *map(features.word_class, words), 0]
        for t, word in enumerate(words):
            gold[r, t] = labels[tags[t]]
            own = probe.ids(features.own(word)) + [offsets[1] + classes[t], offsets[2] + classes[t + 2], offsets[3] + kind]
            ids += own
            cell += [r * wide + t] * len(own)
    ids, cell = np.array(ids), np.array(cell)
    order = np.argsort(ids, kind="stable")
    ids, cell = ids[order], cell[order]
    used, first = np.unique(ids, return_index=True)
    at = np.searchsorted(used, ids)
    by_cell = np.argsort(cell, kind="stable")
    cells, cell_first = np.unique(cell[by_cell], return_index=True)
    weight, move, start = np.zeros((len(used), states)), np.zeros((states, states)), np.zeros(states)
    params, memory = [weight, move, start], [[np.zeros_like(p), np.zeros_like(p)] for p in (weight, move, start)]
    live = np.arange(wide)[None, :] < length[:, None]
    rows_at = np.arange(n)
    for epoch in range(1, epochs + 1):
        score = np.zeros((n * wide, states))
        score[cells] = np.add.reduceat(weight[at[by_cell]], cell_first)
        score = score.reshape(n, wide, states)
        step, begin = move + mask_move, start + mask_start
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[:, 0] = begin + score[:, 0]
        for t in range(1, wide):
            alpha[:, t] = np.where(live[:, t, None], _log_sum(alpha[:, t - 1, :, None] + step, 1) + score[:, t], alpha[:, t - 1])
        for t in range(wide - 2, -1, -1):
            ahead = _log_sum(step + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], ahead, 0)
        total = _log_sum(alpha[:, -1], 1)
        likely = np.exp(alpha + beta - total[:, None, None]) * live[:, :, None]
        back = likely.copy()
        back.reshape(-1, states)[np.flatnonzero(live), gold[live]] -= 1
        grad_move = np.zeros_like(move)
        for t in range(1, wide):
            on = live[:, t]
            pair = alpha[on, t - 1, :, None] + step + (score[on, t] + beta[on, t])[:, None, :] - total[on, None, None]
            grad_move += np.exp(pair).sum(0)
            np.add.at(grad_move, (gold[on, t - 1], gold[on, t]), -1)
        grad_start = likely[:, 0].sum(0) - np.bincount(gold[rows_at, 0], minlength=states)
        grad_weight = np.add.reduceat(back.reshape(-1, states)[cell], first)
        for p, g, (m, v) in zip(params, (grad_weight, grad_move, grad_start), memory):
            g = g / n + decay * p
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    full = np.zeros((offsets[-1], states))
    full[used] = weight
    own, before, after, text = np.split(full, offsets[1:-1])
    return Model(features, own, before, after, text, move + mask_move, start + mask_start)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def viterbi(score: np.ndarray, length: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best labels of a batch of lines: (lines, words, labels) scores, padded. Ties go to the lower label."""
    n, wide, states = score.shape
    best, back = start + score[:, 0], np.zeros((n, wide, states), np.int8)
    for t in range(1, wide):
        step = best[:, :, None] + move
        come = step.argmax(1)
        here = np.take_along_axis(step, come[:, None, :], 1)[:, 0] + score[:, t]
        on = (t < length)[:, None]
        best = np.where(on, here, best)
        back[:, t] = np.where(on, come, np.arange(states))
    path = np.zeros((n, wide), np.int64)
    path[:, -1] = best.argmax(1)
    rows = np.arange(n)
    for t in range(wide - 1, 0, -1):
        path[:, t - 1] = back[rows, t, path[:, t]]
    return path


class Decoder:
    """Spans of a model in whole texts; every distinct word is looked at once while remembered."""

    #: Words of a batch of padded lines, unless one line is longer.
    BATCH_WORDS = 200_000

    def __init__(self, model: Model):
        self.model = model
        f = model.features
        self.kinds = [name[2:] for name in f.labels]
        self.states = len(f.labels)
        gain = lambda table: table - table[:, :1]
        # The most that the words around can add, whether there is a word or an edge.
        self.gain_before = np.maximum(gain(model.before), gain(model.before[:1]))
        self.gain_after = np.maximum(gain(model.after), gain(model.after[:1]))
        self.gain_text = gain(model.text)
        # A word with a label has at most two steps that differ from outside to outside.
        self.gain_move = 2 * max(0.0, float((model.move - model.move[OUT, OUT]).max()), float((model.start - model.start[OUT]).max()))
        self.begin()

    def begin(self) -> None:
        self.number = _Numbers()
        self.vectors: dict[tuple[str, ...], np.ndarray] = {}
        self.own, self.kind = np.zeros((1024, self.states)), np.zeros(1024, np.int64)

    def learn(self) -> None:
        new, self.number.new = self.number.new, []
        n = len(self.number)
        if n > len(self.kind):
            self.own = np.resize(self.own, (2 * n, self.states))
            self.kind = np.resize(self.kind, 2 * n)
        own, kind, vectors = self.model.features.own, self.model.features.word_class, self.vectors
        for k, word in enumerate(new, n - len(new)):
            features = tuple(own(word))
            if features not in vectors:
                vectors[features] = self.model.own[self.model.ids(features)].sum(0)
            self.own[k] = vectors[features]
            self.kind[k] = kind(word)

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of each text, by start; positions in characters."""
        if len(self.number) > CACHE_WORDS:
            self.begin()
        f = self.model.features
        words = [np.fromiter(map(self.number.__getitem__, f.word.findall(t)), np.int64) for t in texts]
        self.learn()
        kinds = [f.text_class(t) for t in texts]
        chains = []  # (text, places, numbers)
        for k, ids in enumerate(words):
            if len(ids) and self._may_gain(ids, kinds[k]):
                for a, b in (f.chains or lines)(texts[k]):
                    places = [m.span() for m in f.word.finditer(texts[k], a, b)]
                    if places:
                        numbers = np.array([self.number[texts[k][i:j]] for i, j in places])
                        if self._may_gain(numbers, kinds[k]):
                            chains.append((k, places, numbers))
        found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        chains.sort(key=lambda x: len(x[1]))
        start = 0
        while start < len(chains):
            wide, end = len(chains[start][1]), start + 1
            while end < len(chains) and len(chains[end][1]) <= max(16, 1.3 * wide) and (end - start) * 1.3 * wide < self.BATCH_WORDS:
                end += 1
            self._decode(chains[start:end], kinds, texts, found)
            start = end
        return [sorted(x, key=lambda s: (s[1], s[2])) for x in found]

    def _may_gain(self, ids: np.ndarray, kind: int) -> bool:
        own, word_kind = self.own[ids], self.kind[ids]
        before, after = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        before[1:], after[:-1] = word_kind[:-1], word_kind[1:]
        most = own[:, 1:] - own[:, :1] + self.gain_before[before, 1:] + self.gain_after[after, 1:] + self.gain_text[kind, 1:]
        return bool((most.max() + self.gain_move) > 0)

    def _decode(self, lines, kinds, texts, found) -> None:
        m, wide = self.model, max(len(x[1]) for x in lines)
        score, length = np.zeros((len(lines), wide, self.states)), np.zeros(len(lines), np.int64)
        for r, (k, places, numbers) in enumerate(lines):
            word_kind = self.kind[numbers]
            n = length[r] = len(places)
            score[r, :n] = self.own[numbers] + m.text[kinds[k]]
            score[r, :n] += m.before[np.concatenate(([0], word_kind[:-1]))] + m.after[np.concatenate((word_kind[1:], [0]))]
        path = viterbi(score, length, m.move, m.start)
        names = m.features.labels
        for r in np.flatnonzero((path != OUT).any(1)):
            k, places, _ = lines[r]
            t, n = 0, length[r]
            while t < n:
                if path[r, t] == OUT:
                    t += 1
                    continue
                first, kind = t, self.kinds[path[r, t]]
                t += 1
                while t < n and names[path[r, t]] == "I-" + kind:
                    t += 1
                span = _trimmed(texts[k], places[first][0], places[t - 1][1])
                if span:
                    found[k].append((kind, *span))


class _Numbers(dict):
    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k


_EDGE = "\"'`<>()[]{}.,;:!?#*$%&|"


def _trimmed(text: str, start: int, end: int) -> tuple[int, int] | None:
    """Without marks at the ends; an opening bracket before a number belongs to it."""
    while start < end and text[start] in _EDGE and not (text[start] == "(" and text[start + 1 : start + 2].isdigit()):
        start += 1
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    return (start, end) if end > start else None


def beside(spans: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that share no character with those taken."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b in taken):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for kind, a, b in spans:
        k = bisect.bisect_right(ends, a)
        if k == len(starts) or starts[k] >= b:
            out.append((kind, a, b))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)
