"""What the text operators share: a scan that runs Python per Arrow batch, word hashes, shingles."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Texts of one call together hold about this many characters, or are a single text.
CALL_CHARS = 4_000_000

# Words that a task remembers before it starts anew.
CACHE_WORDS = 150_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def share_code(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies; a cluster without that path has it installed or sent by --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def give_back() -> None:
    """At the end of a task: return freed memory to the system, for workers live on and later stages need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of jobs that run inside hold about this many bytes, or one row: for rows that are large lists."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_texts(
    docs: DataFrame,
    keep: list[str],
    make: Callable[[], Callable[[list[str]], dict[str, list]]],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Columns computed from whole texts, behind the kept columns; one row per input row.

    ``make`` runs once per task and returns a function from texts to named
    columns; what it remembers goes with the task. Null texts arrive as "". ``schema`` names and types the new columns; a
    kept column of the same name gives way.
    """
    share_code(docs.sparkSession)
    keep = _beside(keep, schema)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    added = StructType.fromDDL(schema)
    out = StructType(rows.schema.fields[: len(keep)] + added.fields)
    types = {f.name: arrow_type(f.dataType.simpleString()) for f in added.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, texts in _calls(batch):
                found = work(texts)
                arrays = [part.column(k) for k in range(len(keep))]
                arrays += [pa.array(found[n], type=t) for n, t in types.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *types])
                del texts, found, arrays
        del work
        give_back()

    return rows.mapInArrow(run, out)


def flat_map_texts(
    docs: DataFrame,
    keep: list[str],
    make: Callable[[], Callable[[list[str]], tuple[list[int], dict[str, list]]]],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """As ``map_texts``, with any number of rows per text: the function also returns each row's text number; its ``done``, if any, is called at the end of a task."""
    share_code(docs.sparkSession)
    keep = _beside(keep, schema)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    added = StructType.fromDDL(schema)
    out = StructType(rows.schema.fields[: len(keep)] + added.fields)
    types = {f.name: arrow_type(f.dataType.simpleString()) for f in added.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, texts in _calls(batch):
                at, found = work(texts)
                if len(at):
                    at = pa.array(at, type=pa.int64())
                    arrays = [part.column(k).take(at) for k in range(len(keep))]
                    arrays += [pa.array(found[n], type=t) for n, t in types.items()]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *types])
                    del arrays
                del texts, found
        getattr(work, "done", lambda: None)()
        del work
        give_back()

    return rows.mapInArrow(run, out)


def map_rows(docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch, list[str]], pa.RecordBatch]], text: str = "text") -> DataFrame:
    """Rows of the same columns: what the function that ``make`` returns leaves of a batch and its texts (null: "")."""
    share_code(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, texts in _calls(batch, at):
                left = work(part, texts)
                if left.num_rows:
                    yield left
                del left, texts
        del work
        give_back()

    return docs.mapInArrow(run, docs.schema)


def filter_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]], text: str = "text") -> DataFrame:
    """The rows whose text passes, with their own columns."""

    def rows():
        passes = make()
        return lambda batch, texts: batch.filter(pa.array(passes(texts), pa.bool_()))

    return map_rows(docs, rows, text)


def _beside(keep: list[str], schema: str) -> list[str]:
    new = StructType.fromDDL(schema).names
    return [c for c in keep if c not in new]


def _calls(batch: pa.RecordBatch, at: int = -1) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    column = batch.column(at if at >= 0 else batch.num_columns - 1)
    start, texts, chars = 0, [], 0
    for k in range(batch.num_rows):
        one = column[k].as_py() or ""
        if texts and chars + len(one) > CALL_CHARS:
            yield batch.slice(start, len(texts)), texts
            start, texts, chars = k, [], 0
        texts.append(one)
        chars += len(one)
    if texts:
        yield batch.slice(start, len(texts)), texts


def arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[name]


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hash of each word. To hash it again costs less than to remember it."""
    try:
        found = b"".join(map(xxhash.xxh64_digest, words))
    except UnicodeEncodeError:
        found = b"".join(xxhash.xxh64_digest(w.encode("utf-8", "surrogatepass")) for w in words)
    return np.frombuffer(found, ">u8").astype(np.uint64)


#: Letters and digits, without marks.
PLAIN_WORD = re.compile(r"[^\W_]+")


class PlainHashes(dict):
    """64-bit hash of each word, blind to case, remembered; ``trim`` bounds the memory."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()

    def of_text(self, text: str) -> np.ndarray:
        return self.of(PLAIN_WORD.findall(text))


class Lookup:
    """Sorted 64-bit keys with a bitmap ahead: where in some values one of the keys occurs."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.map = np.zeros(2**self.BITS, bool)
        self.map[self.keys >> np.uint64(64 - self.BITS)] = True

    def hits(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``values``, and in ``keys``."""
        at = np.flatnonzero(self.map[values >> np.uint64(64 - self.BITS)])
        if len(at) == 0:
            return at, at
        where = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        same = self.keys[where] == values[at]
        return at[same], where[same]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(33))
    values = values * _M1
    values = values ^ (values >> np.uint64(29))
    values = values * _M2
    return values ^ (values >> np.uint64(32))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words; a shorter, non-empty text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = (total + hashes[k : n - width + 1 + k]) * _STEP
        total ^= total >> np.uint64(31)
    return mix(total)
