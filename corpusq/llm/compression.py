"""Quality rules: bands of zstandard ratios over whole documents and fixed chunks.

Repetitive text compresses too well, random or encoded text hardly at all. How
well ordinary text compresses depends on its length, so every band of lengths has
its own limits; long texts are also judged by fixed chunks, which shows a
repetitive or random part that the whole hides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from corpusq.llm.texts import filter_texts, map_texts

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of raw bytes / compressed bytes.

    ``edges``: upper ends (exclusive, bytes) of all bands of lengths but the last.
    ``low``, ``high``: a document of a band is kept if its ratio lies within.
    ``chunk``: bytes of a chunk; what is left at the end of a text is a chunk as well.
    ``chunk_low``, ``chunk_high``: the band of a chunk's ratio. Measured at 4,096 bytes: random printable characters
    1.20, base64 1.31, chunks of sf0.1 at least 2.05.
    ``tail_bytes``: a last chunk under half of ``chunk`` may take so many compressed bytes more, for frame and tables
    weigh more in it (measured on sf0.1, from 256 bytes on: base64 takes more, no text does).
    ``bad_share``: a document is rejected if more than this share of its chunks is outside; a last chunk under half
    of ``chunk`` counts by its bytes.
    """

    edges: tuple[int, ...] = (256, 1024, 4096, 16384)
    low: tuple[float, ...] = (0.75, 1.05, 1.25, 1.4, 1.5)
    high: tuple[float, ...] = (4.0, 6.0, 8.0, 10.0, 12.0)
    chunk: int = 4096
    chunk_low: float = 1.4
    chunk_high: float = 8.0
    tail_bytes: int = 40
    bad_share: float = 0.3
    level: int = 3


#: The rules that come before the bands.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, raw_bytes bigint, zstd_ratio double, n_chunks bigint, n_bad_chunks bigint, verdict string"
)


def compression_rules(docs: DataFrame, keep: list[str], bands: Bands = Bands(), text: str = "text") -> DataFrame:
    """Counts, ratios and a verdict for every whole text, one row per input row.

    A null text counts as empty: no words, ``base_failed``. ``verdict`` is ``base``,
    ``repetitive``, ``incompressible``, ``chunks`` or ``kept``. An empty text has ratio 1.
    """
    return map_texts(docs, keep, lambda: _Rules(bands), SCHEMA, text)


class _Rules:
    def __init__(self, bands: Bands):
        self.bands = bands
        self.codec = zstandard.ZstdCompressor(level=bands.level)

    def __call__(self, texts: list[str]) -> dict[str, list]:
        rows = [self.one(t) for t in texts]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return {n: [r[k] for r in rows] for k, n in enumerate(names)}

    def ratio(self, raw: bytes) -> float:
        return len(raw) / len(self.codec.compress(raw)) if raw else 1.0

    def outside(self, piece: bytes) -> bool:
        """Whether the ratio of a chunk lies outside the band."""
        b, packed = self.bands, len(self.codec.compress(piece))
        spare = b.tail_bytes if len(piece) < b.chunk // 2 else 0
        return len(piece) < b.chunk_low * (packed - spare) or len(piece) > b.chunk_high * packed

    def one(self, text: str) -> tuple:
        b, raw = self.bands, text.encode("utf-8", "surrogatepass")
        words = raw.split()  # bytes split at the six ASCII white-space characters
        n_words = len(words)
        word_chars = len(text) - sum(map(text.count, WHITE))
        n_symbols = sum(map(text.count, SYMBOLS))
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        n_dup_lines = len(lines) - len(set(lines))
        n_repeat = repeated_words(words)
        base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
        whole = self.ratio(raw)
        pieces = [raw[k : k + b.chunk] for k in range(0, len(raw), b.chunk)]
        # A text that is one short piece has the band of its length.
        if len(pieces) == 1 and len(raw) < b.chunk // 2:
            pieces.pop()
        judged = [(self.outside(p), 1.0 if len(p) >= b.chunk // 2 else len(p) / b.chunk) for p in pieces]
        bad = sum(out for out, _ in judged)
        bad_weight, weight = sum(w for out, w in judged if out), sum(w for _, w in judged)
        band = int(np.searchsorted(b.edges, len(raw), side="right"))
        if base_failed:
            verdict = "base"
        elif whole > b.high[band]:
            verdict = "repetitive"
        elif whole < b.low[band]:
            verdict = "incompressible"
        elif bad_weight > b.bad_share * weight:
            verdict = "chunks"
        else:
            verdict = "kept"
        return (
            n_words, word_chars, n_symbols, n_dup_lines, n_repeat, base_failed, verdict == "kept",
            len(raw), whole, len(pieces), bad, verdict,
        )


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-2] * len(number) + ids[1:-1]
    if len(number) ** 3 >= 2**62:
        pairs = np.unique(pairs, return_inverse=True)[1]
    codes = pairs * len(number) + ids[2:]
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    hit = np.concatenate((order[1:][same], order[:-1][same]))
    for k in range(3):
        twice[hit + k] = True
    return int(twice.sum())


def kept_documents(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with their own columns."""
    def make():
        rules = _Rules(bands)
        return lambda texts: rules(texts)["kept"]

    return filter_texts(docs, make)
