"""Every registered query against its SQL, and the contract of the entry module."""

import re

import __spark_entry__ as entry
import pytest

from compare import difference, duck

SF = "/root/testdata/sf0.001"
# The operators on training data have tests of their own.
OWN = re.compile(r"op[0-9]+_|pipeline$")
QUERIES, ORACLE = ({k: v for k, v in x.items() if not OWN.match(k)} for x in (entry.queries(), entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_sql_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["query_id", "doc_id", "score", "rank"]
    assert found.count() > 0


def test_stored_tables_are_rebuilt_when_gone_or_outdated(spark, tmp_path):
    import shutil

    from corpusq.registry import fixtures as fx
    from corpusq.sources.storage import delete_path

    sf = tmp_path / "sf"
    sf.mkdir()
    shutil.copy(f"{SF}/documents.parquet", sf / "documents.parquet")
    first = fx.documents_index(spark, str(sf))
    assert fx.documents_index(spark, str(sf)).path == first.path
    delete_path(spark, first.path)
    second = fx.documents_index(spark, str(sf))
    assert second.path != first.path and second.n == first.n
    (sf / "documents.parquet").chmod(0o644)
    spark.read.parquet(f"{SF}/documents.parquet").limit(7).coalesce(1).write.parquet(str(tmp_path / "new"))
    part = next((tmp_path / "new").glob("*.parquet"))
    shutil.copy(part, sf / "documents.parquet")
    assert fx.documents_index(spark, str(sf)).n == 7
