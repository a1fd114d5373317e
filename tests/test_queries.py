import compare
import pytest

from registrum import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connection(SMALL)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_equals_its_sql(spark, con, name):
    got = Q.queries()[name](spark, SMALL).toPandas()
    want = con.execute(Q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(want), "an oracle without rows compares nothing"
    assert compare.rows(got) == compare.rows(want)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
