import pytest

from eodlake import queries
from tests.compare import connect, same

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in queries.ORACLES:
        same(df, con, queries.ORACLES[name])
    else:
        df.collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
