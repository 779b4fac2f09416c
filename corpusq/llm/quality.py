"""Quality classifier: supervised subword embeddings.

Every word is hashed, as are its character n-grams; each hash has a learned
vector. A document is the average of the vectors of its words, n-grams and
repeat marks; a softmax over two classes reads the average. Training is
stochastic gradient descent in numpy on a bounded sample of labelled rows.
As averaging and the last layer are linear, the trained vectors fold into one
number per hash, which is all that the scoring tasks get.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.texts import CACHE_WORDS, filter_texts, map_texts, mix

# New words whose n-grams are hashed at once: each takes some kB meanwhile.
LEARN_WORDS = 10_000

_P = np.uint64(0x100000001B3)


@dataclass(frozen=True)
class Settings:
    """``per_class``: labelled documents of each class that the fit may use at most.

    Which ones: those with the smallest hash of their id, so the choice is the same
    in every run. ``threshold``: scores from here on mean class 1.
    """

    per_class: int = 2000
    buckets: int = 2**18
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 4
    rate: float = 0.5
    threshold: float = 0.3
    seed: int = 17


@dataclass
class Model:
    """``weight``: what a hash adds to the log odds; ``bias``: those of a text without words."""

    weight: np.ndarray
    bias: float
    settings: Settings


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is never learnt from: crc32 of the id as text is divisible by 5. Null ids count as held out."""
    id_ = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings, label: str = "quality") -> list[tuple[int, str]]:
    """At most ``per_class`` labelled texts of each class, none of them held out.

    Ids labelled both ways are left out. The ids are chosen from the labels alone,
    then the documents are filtered by them (at most 2 ``per_class`` ids).
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id")
        .agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high")
    )
    chosen: dict[int, int] = {}
    for value in (0, 1):
        some = known.where(F.col("low") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.per_class)
        chosen |= {r.doc_id: value for r in some.select("doc_id").collect()}
    if not chosen:
        return []
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id bigint")
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id", "left_semi").collect()
    return sorted((chosen[r.doc_id], r.text) for r in found)


def word_features(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and their n-grams, and how many belong to each word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lens)
    starts = ends - lens
    word_of = np.repeat(np.arange(len(words)), lens)
    place = (np.arange(len(codes)) - starts[word_of]).astype(np.uint64)
    whole = mix(np.add.reduceat(mix(codes * _P + place), starts))
    ids, owner = [whole], [np.arange(len(words))]
    left = ends[word_of] - np.arange(len(codes))
    for n in s.ngrams:
        at = np.flatnonzero(left >= n)
        total = np.full(len(at), n, np.uint64)
        for k in range(n):
            total = total * _P + codes[at + k]
        ids.append(mix(total * _P))
        owner.append(word_of[at])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    # The last bucket is kept for the mark of repeated words.
    buckets = (np.concatenate(ids)[order] % np.uint64(s.buckets - 1)).astype(np.int64)
    return buckets, np.bincount(owner, minlength=len(words))


class _Words(dict):
    """Number of each known word; new words are handed out in one go by ``learn``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k


def _repeats(ids: np.ndarray) -> int:
    return int((ids[1:] == ids[:-1]).sum())


def fit(rows: list[tuple[int, str]], s: Settings = Settings()) -> Model:
    """Train on (class, text) rows. With fewer than two classes every text gets that class (1 if there are no rows)."""
    classes = {c for c, _ in rows}
    if len(classes) < 2:
        return Model(np.zeros(s.buckets, np.float32), 20.0 if classes != {0} else -20.0, s)
    bags = []
    for label, text in rows:
        words = _Words()
        ids = np.fromiter(map(words.__getitem__, text.split()), np.int64)
        if not len(ids):
            continue
        features, per_word = word_features(words.new, s)
        weight = np.repeat(np.bincount(ids, minlength=len(per_word)), per_word).astype(np.float32)
        if r := _repeats(ids):
            features, weight = np.append(features, s.buckets - 1), np.append(weight, np.float32(r))
        features, where = np.unique(features, return_inverse=True)
        total = np.bincount(where, weights=weight).astype(np.float32)
        bags.append((label, features, total / total.sum()))
    rng = np.random.default_rng(s.seed)
    vectors = ((rng.random((s.buckets, s.dim), np.float32) - 0.5) / s.dim).astype(np.float32)
    out, bias = np.zeros((2, s.dim), np.float32), np.zeros(2, np.float32)
    # Both classes are shown equally often: the smaller one is repeated.
    by_class = [[k for k, bag in enumerate(bags) if bag[0] == c] for c in (0, 1)]
    most = max(map(len, by_class))
    turns = np.array([own[k % len(own)] for own in by_class if own for k in range(most)], np.int64)
    steps, done = s.epochs * len(turns), 0
    for _ in range(s.epochs):
        for k in rng.permutation(turns):
            label, features, share = bags[k]
            rate = np.float32(s.rate * (1 - done / steps))
            done += 1
            mean = share @ vectors[features]
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= rate * p
            vectors[features] -= rate * np.outer(share * np.float32(len(features)) ** np.float32(0.5), back)
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]), s)


class Scorer:
    """Scores of texts; what each word adds is remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.start()

    def start(self) -> None:
        self.words = _Words()
        self.sums, self.counts = np.zeros(1024, np.float64), np.zeros(1024, np.int64)

    def learn(self) -> None:
        new, self.words.new = self.words.new, []
        if not new:
            return
        n = len(self.words)
        if n > len(self.sums):
            self.sums = np.resize(self.sums, 2 * n)
            self.counts = np.resize(self.counts, 2 * n)
        for start in range(0, len(new), LEARN_WORDS):
            some, at = new[start : start + LEARN_WORDS], n - len(new) + start
            features, per_word = word_features(some, self.model.settings)
            self.counts[at : at + len(some)] = per_word
            self.sums[at : at + len(some)] = np.add.reduceat(self.model.weight[features].astype(np.float64), np.cumsum(per_word) - per_word)

    def __call__(self, texts: list[str]) -> dict[str, list]:
        if len(self.words) > CACHE_WORDS:
            self.start()
        mark = float(self.model.weight[-1])
        bags = [np.fromiter(map(self.words.__getitem__, t.split()), np.int64) for t in texts]
        self.learn()
        scores = []
        for ids in bags:
            repeats = _repeats(ids)
            n = int(self.counts[ids].sum()) + repeats
            odds = self.model.bias + (float(self.sums[ids].sum()) + repeats * mark) / max(1, n)
            scores.append(1 / (1 + float(np.exp(-min(30.0, max(-30.0, odds))))))
        return {"score": scores, "predicted": [int(x >= self.model.settings.threshold) for x in scores]}


def score_texts(docs: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``score`` (0 to 1, higher: class 1 likelier) and ``predicted`` for every whole text.

    Null texts are empty; empty texts get the bias alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, keep, lambda: Scorer(sent.value), "score double, predicted int", text)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    return fit(labelled_sample(docs, labels, settings), settings)


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents whose predicted class is 1, with their own columns."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, settings))

    def make():
        scorer = Scorer(sent.value)
        return lambda texts: [p == 1 for p in scorer(texts)["predicted"]]

    return filter_texts(docs, make)
