import os

import pytest

from slabworks.plans import catalog
from tests.conftest import SF
from tests.support import compare

SMALL = SF
LARGE = SF.replace("0.001", "0.01")


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    compare(catalog.QUERIES[name](spark, SMALL), catalog.SQL[name], SMALL)
    if os.environ.get("SLABWORKS_LARGE"):
        compare(catalog.QUERIES[name](spark, LARGE), catalog.SQL[name], LARGE)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0
