"""Every registered query against its SQL on the test tables."""

import pytest

from rtmart import oracle, registry
from tests import check

SQL = oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(SQL) == set(registry.queries())


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, sf_dir, name):
    # Streaming queries write many small folders, so they take the smallest tables here.
    folder = sf_dir.replace("sf0.01", "sf0.001") if name.endswith("_stream") else sf_dir
    ok, message = check.compare(registry.queries()[name](spark, folder), check.duck(folder), SQL[name])
    assert ok, message


def test_flagship_has_24_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 24
