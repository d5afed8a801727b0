import duckdb
import pytest
from oracle import TABLES, compare

from landtide.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_oracle(spark, name):
    compare(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF)


@pytest.mark.parametrize("name", ["signals_document", "signals_combined"])
def test_documents_without_signals(spark, tmp_path, name):
    for t in set(TABLES) - {"orders"}:
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    duckdb.connect().execute(f"COPY (SELECT * FROM '{SF}/orders.parquet' WHERE o_orderkey % 5 > 1) TO '{tmp_path}/orders.parquet'")
    compare(spark, catalog.QUERIES[name], catalog.ORACLES[name], str(tmp_path))


def test_all_queries_have_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["cell", "we", "q", "n", "r"]
    assert set(catalog.QUERIES) <= set(e.queries())
