import oracle
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert oracle.compare(df, con, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7
    assert [r.epoch_ms for r in rows] == sorted(r.epoch_ms for r in rows)
