"""Registered corpus queries against their DuckDB twins."""
import pytest

from helpers import canonical, duck
from txwatch.llm.catalog import ORACLE_SQL, QUERIES

MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", list(ORACLE_SQL))
def test_twin(spark, key):
    got = QUERIES[key](spark, MID).toPandas()
    want = duck(MID).execute(ORACLE_SQL[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
