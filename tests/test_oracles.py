"""Every registered query next to its SQL, on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare  # noqa: E402

from compoundry.checks import catalog, fixtures  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in fixtures.BASE_TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    status, n, m, _, _, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert status in ("ok", "rows"), f"{name}: {n} / {m} rows, {note}"
    assert n > 0
