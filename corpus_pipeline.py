"""A training corpus from raw documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusq.llm import decontaminate, near_duplicates, packing, pii, quality, tokens
from corpusq.llm.texts import read_table
from corpusq.sources.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return near_duplicates.first_of_class(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.mask_pii(docs)


#: Tokens of a training sequence.
SEQUENCE_TOKENS = 2048


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return packing.pack(tokens.token_pieces(docs, ["doc_id"], SEQUENCE_TOKENS), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("minhash near-dedup", distinct_texts),
    ("benchmark decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("best-fit packing", packed),
]

#: Trained models, sampling hashes and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    rows = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = materialize(stage(spark, rows, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, rows, sf_dir)
