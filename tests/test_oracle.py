"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_listed():
    # Queries of the training-data subpackage have their own tests, if it is there.
    rows_only = {q for q in set(QUERIES) - set(ORACLES) if q != "pipeline" and not q.startswith("op")}
    assert rows_only == set()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q != "pipeline" and not q.startswith("op")))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_SMALL)
    if name not in ORACLES:
        assert r["rows"] > 0
        return
    assert r["cols_equal"], r.get("cols")
    assert r["types_equal"], r.get("types")
    assert r["rows"] == r["oracle_rows"]
    assert r["exact"], (r.get("only_spark"), r.get("only_duck"))


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "aggregation_granularity" in df.columns
