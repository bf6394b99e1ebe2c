import pytest

import __spark_entry__
from lexmill.queries import ORACLES, QUERIES

from .conftest import SMALL, same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    same(QUERIES[name](spark, SMALL), duck, ORACLES[name])


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
