"""Every registered query against its DuckDB oracle (the driver's check), on the
smallest scale with tiny segments, so halo and prefix paths are exercised."""

import pytest

from flowframe.plans import catalog
from tests.conftest import SF_SMALL

from tools.check_oracles import compare, duck

NAMES = sorted(catalog.REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    q = catalog.REGISTRY[name]
    status, msg = compare(spark, con, name, q.build, q.sql, SF_SMALL)
    assert status in ("OK", "ROWS"), msg
