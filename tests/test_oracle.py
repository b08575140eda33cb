"""Every query of the log engine against its DuckDB oracle at sf0.001 (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from blocklake.plans.queries import REGISTRY
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
SLOW = {"stream_kv_last", "stream_kv_edges", "stream_files"}  # covered by test_streaming


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in SLOW])
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["cols_match"] and r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(REGISTRY) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())
