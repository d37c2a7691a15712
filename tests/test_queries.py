"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from termledger.plans.oracle import ORACLE
from termledger.plans.queries import QUERIES

@pytest.fixture(scope="module")
def database(tiny):
    return connect(tiny)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, tiny, database):
    assert difference(QUERIES[name](spark, tiny), database, ORACLE[name]) == ""


def test_comparison_notices_a_wrong_value(spark, tiny, database):
    wrong = ORACLE["count_grouped"].replace("count(*)", "count(*) + 1")
    assert difference(QUERIES["count_grouped"](spark, tiny), database, wrong)


def test_entry(spark):
    import importlib.util

    from conftest import ROOT

    spec = importlib.util.spec_from_file_location("entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())
