"""The queries that SQL can express, against DuckDB."""
import pytest

from oracle_compare import compare, duck
from starledger.llm.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, key, sf):
    sf_dir = f"/root/testdata/{sf}"
    r = compare(spark, duck(sf_dir), key, QUERIES[key], ORACLE[key], sf_dir)
    assert r["status"] == "OK", r


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_has_rows_and_no_void_columns(spark, key):
    df = QUERIES[key](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
    assert all(t != "void" for _, t in df.dtypes)
