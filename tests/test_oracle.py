"""Every registered query against its SQL twin on DuckDB (rows-only where there is none)."""

import os

import pytest

from ledgerlane import plans
from tests.check import compare, duck
from tests.conftest import SF01, SF001

#: The largest tables take as long as all other tests together.
SIZES = [SF001, SF01] + (["/root/testdata/sf0.1"] if os.environ.get("ALL_SIZES") else [])

NAMES = sorted(plans.QUERIES)


@pytest.fixture(scope="module")
def con():
    return {sf: duck(sf) for sf in SIZES}


@pytest.mark.parametrize("sf", SIZES, ids=os.path.basename)
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name, sf):
    r = compare(spark, name, plans.QUERIES[name], plans.ORACLE[name], sf, con[sf])
    assert r["ok"], r


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
