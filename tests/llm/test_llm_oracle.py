"""Registered queries against their DuckDB statements on a small scale; the rest have brute-force tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from blocklake.llm.oracle import ORACLE  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    from compare import compare

    got = compare(spark, name, SF)
    assert got["cols_match"] and got["values_match"], got
    assert got["spark_rows"] == got["oracle_rows"] > 0


def test_registered(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") and n.split("_")[0][2:].isdigit()]
    assert sorted({int(n.split("_")[0][2:]) for n in names}) == list(range(1, 14))
    assert "pipeline" in entry.queries()
