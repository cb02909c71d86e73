"""Every registered query with a SQL twin equals DuckDB on the same tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import digest

NAMES = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck_small.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    h1, _ = digest(df.columns, rows)
    h2, _ = digest(rel.columns, orows)
    assert h1 == h2


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "prediction", "count"]
    assert df.count() >= 1


def test_every_query_has_docstring():
    for name, fn in E.queries().items():
        assert fn.__doc__, name
