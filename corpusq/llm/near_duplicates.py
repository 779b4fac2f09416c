"""Near duplicates by consistent weighted sampling.

A text is a weighted set of word shingles: how often a shingle occurs times its
smoothed inverse document frequency. Improved consistent weighted sampling draws
samples of it that two texts share with a probability equal to their weighted
Jaccard similarity. Samples are joined into bands; texts that share a band are
candidates, and the exact weighted similarity decides.

Document frequencies are exact, of every shingle's 64-bit hash. Texts are packed into
chunks; the different shingles of a chunk are dealt out by their hash, summed there,
and the frequencies over 1 go back to the chunk. So no table grows with the corpus in one place.

Exact copies are one text from the start. Within a band's bucket texts are first
compared with a central one, so a bucket of n texts costs n comparisons; linked
texts form classes. What is then still in one bucket but in different classes is
compared pair by pair, unless the samples rule a link out, so no link that
sampling finds is lost to the choice of the centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.texts import batches_of, give_back, mix, share_code, shingles, word_hashes
from corpusq.sources.storage import materialize, materialize_bucketed


@dataclass(frozen=True)
class Settings:
    """``samples`` / ``rows`` bands. At similarity 0.8 a pair misses all 16 bands of 4 rows with a probability of 0.0002.

    ``idf``: an inverse document frequency counts 1 + idf * ln((N + 1) / (df + 1)) / ln(2**df_bits), so
    that a shingle of many copies still counts; without that, the parts that a large group of copies
    shares would weigh next to nothing and its edits everything.
    """

    size: int = 5
    similar: float = 0.8
    samples: int = 64
    rows: int = 4
    df_bits: int = 18
    idf: float = 0.25
    seed: int = 29

    @property
    def bands(self) -> int:
        return self.samples // self.rows

    @property
    def least_matches(self) -> int:
        """A pair of the wanted similarity shares at least so many samples (30 of 64), but for less than 1 in 100 million."""
        p = self.similar
        return int(p * self.samples - 6.6 * (self.samples * p * (1 - p)) ** 0.5)


@dataclass
class Weights:
    """``rows``: all documents. ``grams``, ``df``: frequencies of shingles, sorted; those of others are 1 (or handed over with a text)."""

    rows: int
    settings: Settings
    grams: np.ndarray | None = None
    df: np.ndarray | None = None

    def of(self, df: np.ndarray) -> np.ndarray:
        s = self.settings
        return 1 + s.idf * np.log((self.rows + 1) / (df + 1.0)) / (s.df_bits * np.log(2))

    @property
    def idf(self) -> np.ndarray:
        """By the first ``df_bits`` bits of a hash, the weight of the most frequent shingle there."""
        df = np.zeros(2**self.settings.df_bits)
        np.maximum.at(df, (self.grams >> np.uint64(64 - self.settings.df_bits)).astype(np.int64), self.df)
        return self.of(df)


_POOL_BITS, _BLOCK = 12, 16


@lru_cache
def _pool(samples: int, seed: int) -> np.ndarray:
    """Draws of every sample for 2**12 hash values; the samples use other bits of the hash in blocks of 16.

    By block, hash value and sample: 1 / r, beta, r, and ln c - r + r beta, for
    with them t = floor(ln w / r + beta) and ln a = (ln c - r + r beta) - r t.
    """
    rng = np.random.default_rng(seed)
    shape = (2**_POOL_BITS, samples)
    r, c, beta = rng.gamma(2.0, 1.0, shape), rng.gamma(2.0, 1.0, shape), rng.random(shape)
    draws = np.stack((1 / r, beta, r, np.log(c) - r + r * beta), 1).astype(np.float32)
    return np.stack([draws[:, :, k : k + _BLOCK] for k in range(0, samples, _BLOCK)])


class Bags:
    """Weighted shingle sets of texts."""

    def __init__(self, weights: Weights):
        self.weights = weights

    def all_shingles(self, text: str) -> np.ndarray:
        return shingles(word_hashes(text.lower().split()), self.weights.settings.size)

    def shingles(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.all_shingles(text), return_counts=True)

    def bag(self, text: str, df: np.ndarray | np.int64 | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``df``: the frequencies of the different shingles, in order of their hashes."""
        grams, counts = self.shingles(text)
        if df is None:
            df = np.ones(len(grams))
            if len(self.weights.grams):
                at = np.minimum(np.searchsorted(self.weights.grams, grams), len(self.weights.grams) - 1)
                df = np.where(self.weights.grams[at] == grams, self.weights.df[at], df)
        return grams, counts * self.weights.of(df)


@lru_cache(8)
def _pool_scores(samples: int, seed: int, log_w: float) -> np.ndarray:
    """ln a of every draw of the pool for a shingle of that weight; a row per block and hash value."""
    return _scores(_pool(samples, seed).reshape(-1, 4, _BLOCK).copy(), np.float32(log_w))


def _scores(draws: np.ndarray, log_w: np.ndarray) -> np.ndarray:
    """ln a of draws of the pool, which are written over."""
    t = draws[:, 0]
    t *= log_w
    t += draws[:, 1]
    np.floor(t, t)
    a = draws[:, 3]
    a -= draws[:, 2] * t
    return a


def sample(grams: np.ndarray, weights: np.ndarray, s: Settings, usual: float = 1.0) -> np.ndarray:
    """One 64-bit sample per draw: which shingle won, and the level t of its weight.

    For weight w: t = floor(ln w / r + beta), ln y = r (t - beta), a = c / (y e^r);
    the smallest a wins. Ties go to the smaller shingle. ``usual`` is a weight that
    many shingles have, whose a are kept; the samples do not depend on it.
    """
    pool = _pool(s.samples, s.seed).reshape(-1, 4, _BLOCK)
    low = np.full(s.samples, np.inf, np.float32)
    won, level = np.zeros(s.samples, np.uint64), np.zeros(s.samples, np.float32)
    logs, log_usual = np.log(weights).astype(np.float32), np.log(np.array([usual])).astype(np.float32)[0]
    kept = _pool_scores(s.samples, s.seed, float(log_usual))
    blocks, each = np.arange(s.samples // _BLOCK), np.arange(s.samples)
    shifts, first = (_POOL_BITS * (blocks % 5)).astype(np.uint64), blocks << _POOL_BITS
    for start in range(0, len(grams), 2048):
        part, log_w = grams[start : start + 2048], logs[start : start + 2048]
        rows = ((part[:, None] >> shifts) & np.uint64(2**_POOL_BITS - 1)).astype(np.int64) + first
        a = kept.take(rows, 0)
        other = np.flatnonzero(log_w != log_usual)
        if len(other):
            a[other] = _scores(pool.take(rows[other].ravel(), 0), np.repeat(log_w[other], len(blocks))[:, None]).reshape(len(other), *a.shape[1:])
        a = a.reshape(len(part), s.samples)
        best = a.argmin(0)
        least = a[best, each]
        better = least < low
        draws = pool[rows[best, each // _BLOCK], :, each % _BLOCK]
        t = np.floor(draws[:, 0] * log_w[best] + draws[:, 1])
        low[better], won[better], level[better] = least[better], part[best][better], t[better]
    return mix(won + level.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# Bytes of the texts of a chunk, and of the texts whose shingles one task sums up.
CHUNK_BYTES, PART_BYTES = 4 * 2**20, 16 * 2**20
# The least number of parts is 2**8.
_LEAST_PART_BITS = 8


def _packed(usable: DataFrame) -> DataFrame:
    """Different texts in chunks: key, id, copies and text of each as lists; the smallest id of a text's rows.

    Chunks have numbers and lie in files by their hash, so that what is joined to them moves and the texts do not.
    """
    share_code(usable.sparkSession)
    texts = usable.select("id", text_key().alias("key"), "text").groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("text").alias("text")
    )
    kinds = dict(texts.dtypes)
    schema = "chunk bigint, bytes bigint, rows bigint, " + ", ".join(f"{c} array<{kinds[c]}>" for c in ("key", "id", "copies", "text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lists = [pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole.column(c)) for c in ("key", "id", "copies", "text")]
            front = [pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([sum(whole.column("copies").to_pylist())], pa.int64())]
            return pa.RecordBatch.from_arrays([*front, *lists], names=["chunk", "bytes", "rows", "key", "id", "copies", "text"])

        for batch in batches:
            start = 0
            for k, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
                if size and size + n > CHUNK_BYTES:
                    held.append(batch.slice(start, k - start))
                    yield row()
                    held, size, start, number = [], 0, k, number + 1
                size += n
            held.append(batch.slice(start))
        if held:
            yield row()

    buckets = int(usable.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize_bucketed(texts.mapInArrow(pack, schema), "packed", "chunk", buckets)


def _frequencies(packed: DataFrame, s: Settings) -> tuple[DataFrame, int, int]:
    """(chunk, part, grams, df) of all stretches of a chunk's shingles in which one has a frequency over 1; the bits of a part's number; all rows.

    The different shingles of a chunk, sorted, are cut into parts by their first bits.
    Equal shingles of all chunks meet in one task, a row of them for each chunk.
    """
    size, rows = packed.agg(F.sum("bytes"), F.sum("rows")).first()
    bits = max(_LEAST_PART_BITS, int(np.ceil(np.log2(max(1, (size or 0) / PART_BYTES)))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = Bags(Weights(0, s))
        for batch in batches:
            for k in range(batch.num_rows):
                copies = batch.column(1)[k].values.to_numpy()
                each = [np.unique(bags.all_shingles(t.as_py())) for t in batch.column(2)[k].values]
                grams, where = np.unique(np.concatenate(each), return_inverse=True)
                n = np.bincount(where, np.repeat(copies, [len(x) for x in each]), len(grams)).astype("<i8")
                edges = _edges(grams, bits)
                full = np.flatnonzero(edges[1:] > edges[:-1])
                spans = [slice(edges[p], edges[p + 1]) for p in full]
                columns = [[batch.column(0)[k].as_py()] * len(full), full.tolist(), [_squeezed(grams[x]) for x in spans], [n[x].tobytes() for x in spans]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["chunk", "part", "grams", "n"])
                del each, grams, where, n, columns
        del bags
        give_back()

    def add(table: pa.Table) -> pa.Table:
        packs, counts = table["grams"].to_pylist(), table["n"].to_pylist()
        grams = np.concatenate([_stretched(x) for x in packs])
        n = np.concatenate([np.frombuffer(x, "<i8") for x in counts])
        known, where = np.unique(grams, return_inverse=True)
        df = np.bincount(where, n, len(known)).astype("<i8")[where]
        ends = np.cumsum([len(x) // 8 for x in counts])
        parts = [df[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        some = [k for k, x in enumerate(parts) if (x > 1).any()]
        left = table.take(pa.array(some, pa.int64()))
        return pa.table({"chunk": left["chunk"], "part": left["part"], "grams": left["grams"], "df": pa.array([parts[k].tobytes() for k in some], pa.binary())})

    rows_ = packed.select("chunk", "copies", "text").mapInArrow(cut, "chunk bigint, part int, grams binary, n binary")
    return rows_.groupBy("part").applyInArrow(add, "chunk bigint, part int, grams binary, df binary"), bits, int(rows or 0)


def _edges(grams: np.ndarray, bits: int) -> np.ndarray:
    """Where each part of sorted hashes begins, and the end of the last."""
    starts = np.arange(2**bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(grams, starts), len(grams))


def _squeezed(grams: np.ndarray) -> bytes:
    """Sorted hashes as the first one and differences of as many bytes as the largest needs."""
    steps = np.diff(grams)
    wide = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    return bytes([wide]) + grams[:1].astype("<u8").tobytes() + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def _stretched(packed: bytes) -> np.ndarray:
    wide, first = packed[0], np.frombuffer(packed, "<u8", 1, 1)
    steps = np.frombuffer(packed, np.uint8, offset=9).reshape(-1, max(wide, 1))
    full = np.zeros((len(steps), 8), np.uint8)
    full[:, :wide] = steps
    return np.cumsum(np.concatenate((first, full.view("<u8")[:, 0])), dtype=np.uint64)


def document_weights(docs: DataFrame, s: Settings, text: str = "text") -> Weights:
    """Inverse document frequencies over all documents, copies included, of a corpus whose shingles one process can hold."""
    usable = docs.where(F.col(text).isNotNull()).select(F.lit(0).cast("long").alias("id"), F.col(text).alias("text"))
    found, _, rows = _frequencies(_packed(usable), s)
    table = found.select("grams", "df").toArrow()
    grams = np.concatenate([np.zeros(0, np.uint64), *(_stretched(x) for x in table["grams"].to_pylist())])
    df = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, "<i8") for x in table["df"].to_pylist())])
    grams, at = np.unique(grams, return_index=True)
    return Weights(rows, s, grams, df[at])


def text_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, class_id (the smallest id of its class), copies (rows of the very same text) and class_texts (different texts of the class).

    A class is what links of at least ``similar`` connect. Texts of fewer words
    than a shingle are one shingle of what they have; texts without words are
    classes of equal texts. A null text is a class of its own; a row without an id
    has no class. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    drawn, classes = _classed(docs, settings)
    # The copies of a text may be a large share of all rows; the classes are one row a text.
    found = drawn.select("id", "key").join(classes, "key").select("id", "class_id", "copies", "class_texts")
    one = F.lit(1).cast("long")
    rest = docs.where("id is null or text is null").select("id", F.col("id").alias("class_id"), one.alias("copies"), one.alias("class_texts"))
    return found.unionAll(rest).withColumnRenamed("id", id_)


def first_of_class(docs: DataFrame, settings: Settings = Settings(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with its own columns: that with the smallest id, of repeated rows any one.

    Rows without an id or text are in no class and all stay.
    """
    drawn, classes = _classed(docs.select(F.col(id_).alias("id"), F.col(text).alias("text")), settings)
    rows = drawn.groupBy("id", "key").agg(F.count("*").alias("__rows")).join(classes, "key")
    first = rows.groupBy("class_id").agg(F.min_by(F.struct("id", "key", "__rows"), F.struct("id", "key")).alias("x")).select("x.*")
    first = materialize(first.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "__rows"), "first")
    known = F.col(id_).isNotNull() & F.col(text).isNotNull()
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__doc")
    marked = docs.where(known).select(whole, F.col(id_).alias("__at"), text_key(text).alias("__text_key"))
    kept = marked.join(first, (F.col("__at") == F.col("__id")) & (F.col("__text_key") == F.col("__key")))
    once = kept.where("__rows = 1").select("__doc.*")
    repeated = kept.where("__rows > 1").dropDuplicates(["__id"]).select("__doc.*")
    return once.unionAll(repeated).unionAll(docs.where(~known))


def _classed(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Usable rows as (id, key of the text), and (key, class_id, copies, class_texts) for every different text."""
    usable = docs.where("id is not null and text is not null")
    packed = _packed(usable)
    found, bits, rows = _frequencies(packed, s)
    stretches = found.select("chunk", F.struct("part", "df").alias("one")).groupBy("chunk").agg(F.collect_list("one").alias("stretches"))
    weights = Weights(rows, s)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, usual = Bags(weights), float(weights.of(np.float64(1)))
        edge = (np.arange(s.bands, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            for k in range(batch.num_rows):
                keys, ids, copies, texts, known = (batch.column(c)[k] for c in range(5))
                each = [bags.shingles(t.as_py()) for t in texts.values]
                grams, where = np.unique(np.concatenate([g for g, _ in each]), return_inverse=True)
                all_df, edges = np.ones(len(grams), np.int64), _edges(grams, bits)
                for one in known.as_py() or []:
                    all_df[edges[one["part"]] : edges[one["part"] + 1]] = np.frombuffer(one["df"], "<i8")
                all_df, at, bands, samples, dfs = all_df[where], 0, [], [], []
                for g, counts in each:
                    df, at = all_df[at : at + len(g)], at + len(g)
                    dfs.append(df.astype("<i8").tobytes() if (df > 1).any() else b"")
                    if len(g) == 0:
                        bands.append([])
                        samples.append(b"")
                        continue
                    drawn = sample(g, counts * weights.of(df), s, usual)
                    total = edge.copy()
                    for r in range(s.rows):
                        total = mix(total * np.uint64(31) + drawn[r :: s.rows])
                    bands.append(total.view(np.int64).tolist())
                    samples.append((drawn & np.uint64(0xFFFF)).astype("<u2").tobytes())
                columns = [keys.values, ids.values, copies.values, pa.array(bands, pa.list_(pa.int64())), pa.array(samples, pa.binary()), pa.array(dfs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "copies", "bands", "samples", "df"])
                del each, grams, where, all_df, dfs, columns
        del bags
        give_back()

    whole = packed.select("chunk", "key", "id", "copies", "text").join(stretches, "chunk", "left").drop("chunk")
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"key binary, id {kind}, copies bigint, bands array<bigint>, samples binary, df binary"
    with batches_of(docs.sparkSession, CHUNK_BYTES):
        texts = materialize(whole.mapInArrow(draw, schema), "texts")
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    labels = _labels(packed, texts, sent, s)
    classes = texts.select("key", "id", "copies").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = classes.groupBy("label").agg(F.min("id").alias("class_id"), F.count("*").alias("class_texts"))
    return usable.select("id", text_key().alias("key")), materialize(classes.join(least, "label").select("key", "class_id", "copies", "class_texts"), "classes")


def _labels(packed: DataFrame, texts: DataFrame, sent, s: Settings) -> DataFrame:
    """(key, label) of all texts that have a link; the label is the smallest key of the class."""
    members = texts.select("key", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(members.join(shared, "bucket"), "members")
    candidates = members.select("key").distinct().join(texts.select("key", "df"), "key")
    each = packed.select(F.explode(F.arrays_zip("key", "text")).alias("one")).select("one.*")
    pool = materialize(each.join(candidates, "key").select("key", "text", "df"), "pool")
    # The centre of a bucket is the text that shares the most buckets with others.
    central = members.groupBy("key").agg(F.sum("n").alias("weight"))
    leaders = members.join(central, "key").groupBy("bucket").agg(F.max(F.struct("weight", "key"))["key"].alias("leader"))
    led = members.join(leaders, "bucket").where("key <> leader").select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b"))
    compared = materialize(_verified(led.distinct(), pool, sent), "compared")
    links = compared.where(F.col("similarity") >= s.similar).select("a", "b")
    labels = connected(links)
    # Links across classes that no centre has shown.
    placed = members.join(labels, "key", "left").select("bucket", "key", "n", F.coalesce("label", "key").alias("label"))
    split = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
    placed = placed.join(split, "bucket").join(texts.select("key", "samples", "bands"), "key")
    placed = materialize(placed, "placed")
    blocks = _blocks(placed, F.ceil(F.col("n") / BLOCK_TEXTS))
    with batches_of(packed.sparkSession, CHUNK_BYTES):
        hopeful = materialize(_met(blocks, "bucket bigint, key binary", lambda: _hopeful(s)).distinct(), "hopeful")
    # Only texts with such a partner are read, again in blocks of bounded size.
    sized = hopeful.join(placed.drop("n"), ["bucket", "key"]).join(pool, "key")
    total = sized.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("df")).alias("bytes"))
    blocks = _blocks(sized.join(total, "bucket"), F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("bytes") / BLOCK_BYTES)), "text", "df")
    more = _met(blocks, "a binary, b binary", lambda: _linked(sent.value))
    with batches_of(packed.sparkSession, CHUNK_BYTES):
        links = materialize(links.unionAll(more.distinct()), "links")
    return connected(links)


# Texts of a block, and their bytes: what a task holds is two blocks.
BLOCK_TEXTS, BLOCK_BYTES = 200, 4 * 2**20


def _blocks(members: DataFrame, parts: Column, *more: str) -> DataFrame:
    """The members of each bucket in blocks."""
    block = F.pmod(F.xxhash64("key"), F.greatest(parts, F.lit(1))).cast("int")
    one = F.struct("key", "label", "samples", F.col("bands"), *more)
    return materialize(members.withColumn("block", block).groupBy("bucket", "block").agg(F.collect_list(one).alias("texts")), "blocks")


def _met(blocks: DataFrame, schema: str, make) -> DataFrame:
    """Every two blocks of a bucket in one row, handed to what ``make`` returns; it yields rows."""
    left, right = (blocks.select("bucket", F.col("block").alias(f"block_{side}"), F.col("texts").alias(f"texts_{side}")) for side in "ab")
    met = left.join(right, "bucket").where("block_a <= block_b").select("bucket", (F.col("block_a") == F.col("block_b")).alias("same"), "texts_a", "texts_b")
    fields = [part.split() for part in schema.split(", ")]
    types = pa.schema([(name, {"bigint": pa.int64(), "binary": pa.binary()}[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            rows = set()
            for k in range(batch.num_rows):
                rows.update(work(*(batch.column(c)[k] for c in range(4))))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*sorted(rows)), types.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return met.mapInArrow(run, schema)


class _Block:
    """Keys, labels, samples and bands of the texts of a block, as arrays."""

    def __init__(self, texts: pa.ListScalar, s: Settings):
        self.rows = texts.values
        column = lambda name: b"".join(self.rows.field(name).to_pylist())
        self.keys = self.rows.field("key").to_pylist()
        self.labels = np.frombuffer(column("label"), "V16")
        self.samples = np.frombuffer(column("samples"), "<u2").reshape(-1, s.samples)
        self.bands = np.array(self.rows.field("bands").to_pylist(), np.int64).reshape(-1, s.bands)


def _candidates(bucket: int, same: bool, a: _Block, b: _Block, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different labels with samples enough in common, in the first bucket that they share only."""
    agree = (a.samples[:, None, :] == b.samples[None, :, :]).sum(2)
    wanted = (agree >= s.least_matches) & (a.labels[:, None] != b.labels[None, :])
    i, j = np.nonzero(np.triu(wanted, 1) if same else wanted)
    shared = a.bands[i] == b.bands[j]
    first = a.bands[i, shared.argmax(1)] == bucket if len(i) else np.zeros(0, bool)
    return i[first], j[first]


def _hopeful(s: Settings):
    def work(bucket, same, texts_a, texts_b):
        a, b = _Block(texts_a, s), _Block(texts_b, s)
        i, j = _candidates(bucket.as_py(), same.as_py(), a, b, s)
        return [(bucket.as_py(), a.keys[k]) for k in set(i.tolist())] + [(bucket.as_py(), b.keys[k]) for k in set(j.tolist())]

    return work


def _linked(weights: Weights):
    s, bags = weights.settings, Bags(weights)

    def work(bucket, same, texts_a, texts_b):
        a, b = _Block(texts_a, s), _Block(texts_b, s)
        i, j = _candidates(bucket.as_py(), same.as_py(), a, b, s)
        if len(i) == 0:
            return []
        left, right = ({k: bags.bag(x.rows.field("text")[k].as_py(), _df(x.rows.field("df")[k])) for k in set(at.tolist())} for x, at in ((a, i), (b, j)))
        near = all_jaccard(left, right, i, j) >= s.similar
        return [tuple(sorted((a.keys[x], b.keys[y]))) for x, y in zip(i[near].tolist(), j[near].tolist())]

    return work


def _df(packed: pa.BinaryScalar) -> np.ndarray | np.int64:
    """The frequencies of a text's shingles; none are kept if all are 1."""
    kept = packed.as_py()
    return np.frombuffer(kept, "<i8") if kept else np.int64(1)


def all_jaccard(left: dict[int, tuple], right: dict[int, tuple], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The weighted Jaccard similarity of the pairs (i, j) of two sets of bags.

    The sums of smaller weights come from products of matrices, by stretches of
    shingles and by the few different weights that a shingle has.
    """
    if len(i) < 400:
        return np.array([weighted_jaccard(left[x], right[y]) for x, y in zip(i.tolist(), j.tolist())])
    place = [{k: n for n, k in enumerate(side)} for side in (left, right)]
    sides = []
    for side in (left, right):
        owner, gram, weight = [], [], []
        for n, (grams, weights) in enumerate(side.values()):
            owner.append(np.full(len(grams), n))
            gram.append(grams)
            weight.append(weights)
        sides.append([np.concatenate(x) for x in (owner, gram, weight)])
    known, code = np.unique(np.concatenate((sides[0][1], sides[1][1])), return_inverse=True)
    codes = np.split(code, [len(sides[0][1])])
    low = np.zeros((len(left), len(right)))
    for start in range(0, len(known), 8192):
        parts = []
        for (owner, _, weight), at, n in zip(sides, codes, (len(left), len(right))):
            inside = (at >= start) & (at < start + 8192)
            dense = np.zeros((n, min(8192, len(known) - start)))
            dense[owner[inside], at[inside] - start] = weight[inside]
            parts.append(dense)
        both = parts[0].any(0) & parts[1].any(0)
        x, y = parts[0][:, both], parts[1][:, both]
        # The smaller of two weights, level by level of the weights that occur: a step counts where both reach it.
        floor = np.zeros(x.shape[1])
        while len(floor):
            above_x, above_y = x > floor * (1 + 1e-12), y > floor * (1 + 1e-12)
            step = np.minimum(np.where(above_x, x, np.inf).min(0), np.where(above_y, y, np.inf).min(0))
            live = np.isfinite(step) & above_x.any(0) & above_y.any(0)
            if not live.any():
                break
            gain = np.where(live, step, 0.0) - np.where(live, floor, 0.0)
            low += (above_x * gain) @ above_y.T.astype(float)
            floor = np.where(live, step, np.inf)
    a, b = (np.array([place[k][x] for x in at.tolist()]) for k, at in ((0, i), (1, j)))
    mass = [np.array([w.sum() for _, w in side.values()]) for side in (left, right)]
    both = low[a, b]
    high = mass[0][a] + mass[1][b] - both
    return np.where(high > 0, both / np.where(high > 0, high, 1), 0.0)


def _verified(pairs: DataFrame, pool: DataFrame, sent) -> DataFrame:
    """The exact weighted Jaccard similarity of each pair of texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, known = Bags(sent.value), {}

        def bag(key: bytes, text, df) -> tuple[np.ndarray, np.ndarray]:
            if key not in known:
                if len(known) >= 64:
                    known.clear()
                known[key] = bags.bag(text.as_py(), _df(df))
            return known[key]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = []
            for k in range(batch.num_rows):
                found.append(weighted_jaccard(*(bag(key, batch.column(c)[k], batch.column(c + 1)[k]) for key, c in ((a[k], 2), (b[k], 4)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    text = lambda side: pool.select(F.col("key").alias(side), F.col("text").alias(f"text_{side}"), F.col("df").alias(f"df_{side}"))
    rows = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "df_a", "text_b", "df_b")
    return rows.mapInArrow(compare, "a binary, b binary, similarity double")


def weighted_jaccard(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights by sum of the larger; 0 if both are empty."""
    _, at, other = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(left[1][at], right[1][other]).sum())
    high = float(left[1].sum() + right[1].sum()) - low
    return low / high if high else 0.0


def connected(links: DataFrame) -> DataFrame:
    """(key, label) of every linked key; the label is the smallest key that links lead to.

    Each round takes the smallest label around, then the label of that label, so
    chains shorten by at least half; a round's labels are written to the shared folder.
    """
    both = materialize(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "label"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near"))
        grown = labels.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        ahead = grown.select(F.col("key").alias("label"), F.col("label").alias("next"))
        new = materialize(grown.join(ahead, "label").select("key", F.least("label", "next").alias("label"), "old"), "labels")
        labels = new.select("key", "label")
        if new.where("label <> old").isEmpty():
            return labels

