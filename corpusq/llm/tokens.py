"""Token ids of whole texts by a public tokenizer, with every distinct word encoded once per task.

The tokenizer drops white space and never merges across it, so the ids of a text
are those of its words in order. Pure letter runs of the Latin-1 range are encoded
in lower case, many at a time; all other words one by one, as they are.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame

from corpusq.llm.texts import flat_map_texts

# Remembered words of a call (about 200 bytes each), and of a worker between tasks.
CACHE, KEPT = 400_000, 100_000

# Letters, then marks. The digits and fractions ² ³ ¹ ¼ ½ ¾ are word characters too, but the tokenizer splits them from letters.
_PLAIN = re.compile(r"([^\W\d_²³¹¼½¾]+)([^\w\s']*)")
_loaded: dict[str, WordTokens] = {}


def default_tokenizer() -> str:
    """The file of the installed 49k word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For runs of letters in lower case nothing is left to normalise or to split but the blanks between them.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        end = model["end_of_word_suffix"]
        size = max(model["vocab"].values()) + 1
        self.ends = np.zeros(max(size, self.tokenizer.get_vocab_size()), bool)
        self.ends[[i for word, i in model["vocab"].items() if word.endswith(end)]] = True
        self.words: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {"": b""}

    def forget(self, limit: int = KEPT) -> None:
        if len(self.words) > limit:
            self.words = {"": b""}
        if len(self.cores) > limit:
            self.cores = {"": b""}

    def ids(self, texts: list[str]) -> list[bytes]:
        self.forget(CACHE)
        split = [t.replace("\n", " ").split(" ") for t in texts]
        known, new = self.words, set()
        for words in split:
            new.update(words)
        new -= known.keys()
        if new:
            self._learn(list(new))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _learn(self, words: list[str]) -> None:
        known, odd = self.words, set()
        plain, cores, tails = [], [], []  # no tuples: they would set off garbage collections over all known words
        for w in words:
            m = _PLAIN.fullmatch(w) if w.isascii() or max(w) < "Ā" else None
            if m:
                plain.append(w)
                cores.append(m[1].lower())
                tails.append(m[2])
            else:
                odd.add(w)
        self._learn_cores(list(set(cores) - self.cores.keys()))
        odd = list(odd.union(tails) - known.keys())
        for w, found in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False) if odd else []):
            known[w] = np.array(found.ids, "<u4").tobytes()
        ids = self.cores
        for w, core, tail in zip(plain, cores, tails):
            known[w] = ids[core] + known[tail] if tail else ids[core]

    def _learn_cores(self, cores: list[str]) -> None:
        """A run of letters is one unit of the tokenizer and ends with a token that closes a word."""
        for k in range(0, len(cores), 5000):
            part = cores[k : k + 5000]
            ids = np.array(self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                self.cores.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
            else:
                found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                self.cores.update((w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(part, found))


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of a file, loaded once per worker process."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def token_pieces(docs: DataFrame, keep: list[str], capacity: int, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: piece, start, length, ids_crc32; one or more rows per document.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def make():
        encoder = word_tokens(path)

        def work(texts):
            at, piece, start, length, crc = [], [], [], [], []
            for k, raw in enumerate(encoder.ids(texts)):
                raw += end
                for p, b in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[b : b + 4 * capacity]
                    at.append(k)
                    piece.append(p)
                    start.append(b // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            return at, {"piece": piece, "start": start, "length": length, "ids_crc32": crc}

        work.done = encoder.forget
        return work

    return flat_map_texts(docs, keep, make, "piece int, start bigint, length bigint, ids_crc32 bigint")
