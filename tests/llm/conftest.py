import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"

# Names that operators use inside or return.
CLASHES = ("key", "id", "label", "score", "kept", "bands", "spans", "n", "shard", "offset", "piece", "class_id", "doc")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty texts, a long text, repeated rows, and columns of clashing names."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = " ".join(f"{w}{k}" for k in range(4000) for w in word[:12])
    texts = [(None, None), (None, "some words here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, long), (6, " ".join(word)), (7, " ".join(word)), (8, ""), (9, "x" * 50_000)]
    rows = [Row(doc_id=i, text=t, lang=None if k % 2 else "en", source=None if k % 3 else "s", n_chars=None if t is None else len(t), **dict.fromkeys(CLASHES, "clash")) for k, (i, t) in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([tuple(r) for r in rows], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
