"""Every registered query that has SQL equals it."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, sf, name):
    assert difference(spark, duck, sf, QUERIES[name], SQL[name]) is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["document_id", "url", "title", "content", "n_words"]
    assert df.count() > 0
