"""Every query of the library against its SQL, on the tables the oracle uses."""

import pytest

from omicspark.catalog import ORACLES, QUERIES
from tests.comparing import connection, difference

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
