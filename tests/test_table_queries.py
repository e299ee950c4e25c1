import pytest

import oracle
import tailrace.file_queries  # noqa: F401
from tailrace.table_queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        oracle.assert_same(df, con, ORACLES[name])
    else:
        assert df.count() > 0
