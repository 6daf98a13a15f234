"""Every named query against its SQL."""

import pytest

from suarakit.catalog import QUERIES, SQL
from tests.compare import differences


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert differences(df, SQL[name], sf_dir) is None
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"source", "complaints"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
