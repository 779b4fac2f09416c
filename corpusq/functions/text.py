"""Tokens, stop words, in-row term counts and term buckets.

A document is one row, so everything that concerns a single document is worked
out inside the row. That keeps term counting free of shuffles: the only exchange
of an index build is the one that lays the postings out by bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern. A token starts with a word character, '#' or
# '@' and goes on with 2 to 24 word characters, each optionally after ' or -.
# Word characters are spelled out because Java's \w is ASCII only. The possessive
# quantifiers cannot change a match here; they spare the matcher its backtracking.
# Latin letters and digits come first as well: a table tells those, before Unicode classes are asked.
TOKEN_PATTERN = r"[a-z0-9#@_\p{L}\p{N}](?:['\-]?+[a-z0-9_\p{L}\p{N}]){2,24}+"

# The English stop words of NLTK.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your
    yours yourself yourselves he him his himself she she's her hers herself it
    it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above
    below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no
    nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
    mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn
    wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Words too frequent in an encyclopedia to be of use.
CORPUS_STOP_WORDS = tuple(
    """
    category references also external links may first see history people one
    two part thumb including second following many however would became
    """.split()
)

STOP_WORDS = ENGLISH_STOP_WORDS + CORPUS_STOP_WORDS


def tokens(text: Column) -> Column:
    """All tokens of a text, lower-cased, in order, stop words included."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def kept_tokens(text: Column, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Tokens of a text without the stop words; an empty array for null text."""
    words = sorted(set(stop))
    found = F.coalesce(tokens(text), F.array().cast("array<string>"))
    return F.filter(found, lambda t: ~t.isin(words)) if words else found


def run_starts(ordered: Column) -> Column:
    """Positions where a new value begins in a sorted array, plus its length."""
    end = F.size(ordered)
    return F.filter(
        F.sequence(F.lit(0), end),
        lambda i: (i == 0) | (i == end) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def runs_to_counts(ordered: Column, starts: Column) -> Column:
    """``array<struct<term, tf>>`` from a sorted token array and its run starts."""
    return F.transform(
        F.slice(starts, F.lit(1), F.size(starts) - 1),
        lambda p, j: F.struct(
            F.get(ordered, p).alias("term"),
            (F.get(starts, j + 1) - p).cast("bigint").alias("tf"),
        ),
    )


def term_bucket(term: Column, num_buckets: int) -> Column:
    """Stable bucket of a term: its CRC-32 modulo the number of buckets."""
    return F.pmod(F.crc32(term), F.lit(num_buckets)).cast("int")


def term_bucket_of(term: str, num_buckets: int) -> int:
    """`term_bucket` for one literal term, used to prune partitions."""
    return zlib.crc32(term.encode("utf-8")) % num_buckets
