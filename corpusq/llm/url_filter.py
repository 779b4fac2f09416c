"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

A listing holds two kinds of keys: rules (a host with all its subdomains and the
start of a path) and canonical URLs. Every URL is turned into the few keys that
could be listed; the filter, a bounded array that every task holds, throws out nearly
all keys that are not, and the exact join removes what the filter let through.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusq.llm.texts import share_code
from corpusq.operators.joins import fits_broadcast, sized_join
from corpusq.sources.storage import materialize

ALLOW, BLOCK = "allow", "block"

# Words of 32 bits in a block; a key sets one bit in each.
WORDS = 8

# The filter grows with the listing up to this size and is coarser, but not wrong, beyond.
MAX_BLOCKS = 2**20
KEYS_PER_BLOCK = 16

# Parameters that name the visit and not the page.
TRACKING = "utm_[^=]*|ref|fbclid|gclid|msclkid|mc_cid|mc_eid|sessionid|phpsessid"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; "" without it."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host, path and query of a URL as one text that is equal for addresses of one page; null without a host.

    Scheme, fragment, a leading ``www.``, the ports 80 and 443, ``index.html`` and slashes at
    the end of the path, and tracking parameters are dropped; the other parameters are sorted.
    """
    host = F.regexp_replace(host_of(url), "^www\\.|:(80|443)?$", "")
    path = F.regexp_replace(path_of(url), "(/index\\.html?)?/*$", "")
    query = F.regexp_extract(url, "://[^?#]*\\?([^#]*)", 1)
    named = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)"))
    asked = F.array_join(F.array_sort(named), "&")
    return F.when(host != "", F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise("")))


@dataclass(frozen=True)
class Shape:
    """How many labels of the host and how many characters of the path a rule fixes."""

    labels: int
    path_chars: int


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, keep: list[str], url: str = "url") -> DataFrame:
    """The kept columns with ``host``, ``path``, ``rule`` and ``verdict``, one row per input row.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the path of
    the URL starts with the rule's; the longest wins, of equally long ones that with the longer
    host. Of a rule given twice ``block`` counts. A URL that no rule fits is blocked if its canonical
    form is that of a URL in ``listed(url)``, else allowed.

    Null, empty and host-less URLs have an empty host and path, no rule, and are allowed; null
    and host-less rows of ``listed`` list nothing. Repeated rows stay, each with its verdict. Empty
    tables of rules or listed URLs fit nothing; an empty table of pages gives no rows. A kept column named
    like a new one gives way.
    """
    share_code(pages.sparkSession)
    listing, shapes = _listing(rules, listed)
    small = fits_broadcast(listing)
    passes = _bloom_filter(listing)
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    link = F.col(url).cast("string")
    rows = pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], host_of(link).alias("host"), path_of(link).alias("path"), canonical(link).alias("whole"))
    kept = [f"k{i}" for i in range(len(keep))]
    keyed = rows.select(*kept, "host", "path", _possible_keys(shapes).alias("keys"))
    hashed = keyed.select("*", F.transform("keys", lambda k: F.xxhash64(k)).alias("hashes"))
    schema = StructType([*keyed.schema.fields[:-1], StructField("keys", ArrayType(StringType()))])
    probed = hashed.mapInArrow(passes, schema).withColumn("row", F.monotonically_increasing_id())
    if not small:
        # Joined by a shuffle: how often each key is asked for tells which have to be spread.
        probed = materialize(probed, "probed_urls")
        asked = probed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("rows"))
        listing = materialize(listing.join(asked, "key"), "asked_urls")
    hits = probed.select("row", *kept, "host", "path", F.explode_outer("keys").alias("key"))
    found = sized_join(hits, listing, ["key"], "left", spread="row", small_fits=small, rows=None if small else "rows")
    best = F.max("hit").alias("hit")
    judged = found.groupBy("row", *kept, "host", "path").agg(best)
    names = [F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)]
    return judged.select(*names, "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(ALLOW)).alias("verdict"))


def _listing(rules: DataFrame, listed: DataFrame) -> tuple[DataFrame, list[Shape]]:
    """``(key, hit)`` of all rules and canonical URLs, and the shapes of the rules.

    ``hit`` is ordered so that the greatest counts: by length, host, then ``block`` over ``allow``.
    """
    host, path = (F.coalesce(F.col(c), F.lit("")) for c in ("host", "path"))
    given = rules.select(host.alias("host"), path.alias("path"), "verdict").where("host <> ''")
    labels, chars = F.size(F.split("host", "\\.")), F.length("path")
    shapes = [Shape(*r) for r in given.select(labels, chars).distinct().collect()]
    rule = F.concat("host", "path")

    def hit(length: Column, host_chars: Column, verdict: Column, rule: Column) -> Column:
        return F.struct(length.alias("length"), host_chars.alias("host_chars"), verdict.alias("verdict"), rule.alias("rule"))

    none, nothing = F.lit(0), F.lit(None).cast("string")
    by_rule = given.select(rule.alias("key"), hit(F.length(rule), F.length("host"), F.col("verdict"), rule).alias("hit"))
    whole = listed.select(F.concat(F.lit("="), canonical(F.col("url").cast("string"))).alias("key")).where("key is not null")
    by_url = whole.select("key", hit(none, none, F.lit(BLOCK), nothing).alias("hit"))
    both = by_rule.unionByName(by_url).groupBy("key").agg(F.max("hit").alias("hit"))
    return materialize(both, "listed_urls"), sorted(shapes, key=lambda s: (s.labels, s.path_chars))


def _possible_keys(shapes: list[Shape]) -> Column:
    """The keys by which a URL (``host``, ``path``, ``whole``) could be listed: one per shape, and itself."""

    def of(shape: Shape) -> Column:
        tail = F.substring_index("host", ".", -shape.labels)
        fits = (F.col("host") != "") & (F.size(F.split("host", "\\.")) >= shape.labels) & (F.length("path") >= shape.path_chars)
        return F.when(fits, F.concat(tail, F.substring("path", 1, shape.path_chars)))

    return F.array_compact(F.array(F.concat(F.lit("="), F.col("whole")), *map(of, shapes)))


def _bloom_filter(listing: DataFrame) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch function that leaves of the last column but one, the keys, those that may be listed.

    The upper 24 bits of a key's hash choose a block, the lower 40 a bit in each of its
    words. Blocks are made where the keys are; the driver gets at most ``MAX_BLOCKS`` of them, 32 MB.
    """
    wanted = listing.count() // KEYS_PER_BLOCK + 1
    blocks = min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())
    code = listing.select(F.xxhash64("key").alias("h"))
    block = F.shiftrightunsigned("h", 40).bitwiseAND(F.lit(blocks - 1)).alias("block")
    bit = [F.expr(f"shiftleft(1L, cast((shiftrightunsigned(h, {5 * k}) & 31) as int))").alias(f"w{k}") for k in range(WORDS)]
    made = code.select(block, *bit).groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])
    table = made.toArrow()
    words = np.zeros((blocks, WORDS), np.uint32)
    if table.num_rows:
        at = table.column("block").to_numpy()
        for k in range(WORDS):
            words[at, k] = table.column(f"w{k}").to_numpy().astype(np.uint32)
    shared = listing.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            keys, hashes = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            sizes = np.diff(hashes.offsets.to_numpy())
            values = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            maybe = _may_contain(words, values)
            counts = np.add.reduceat(np.append(maybe, False), np.cumsum(sizes) - sizes) * (sizes > 0) if len(sizes) else sizes
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys.flatten().filter(pa.array(maybe)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], left], names=batch.schema.names[:-1])

    return run


def _may_contain(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    block = (hashes >> np.uint64(40)) & np.uint64(len(words) - 1)
    maybe = np.ones(len(hashes), bool)
    for k in range(words.shape[1]):
        bit = ((hashes >> np.uint64(5 * k)) & np.uint64(31)).astype(np.uint32)
        maybe &= (words[block, k] >> bit) & np.uint32(1) == 1
    return maybe
