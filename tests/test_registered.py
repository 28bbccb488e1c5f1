"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .compare import difference, duck, duck_rows, spark_rows


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", [n for n in queries() if n in oracle_sql()])
def test_query_equals_sql(spark, folder, con, name):
    rows = spark_rows(queries()[name](spark, folder))
    assert difference(rows, duck_rows(con, oracle_sql()[name])) == ""


def test_entry_runs(spark):
    assert entry(spark).count() == 10


def test_each_sql_has_a_query():
    """Queries without SQL are those of the training-data operators, tested on their own."""
    assert set(oracle_sql()) <= set(queries())
    bare = set(queries()) - set(oracle_sql())
    assert all(n == "pipeline" or n.startswith("op") for n in bare)
