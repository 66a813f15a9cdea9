"""Every query of the core runs; those with SQL give the same rows."""

import pytest

from loamline.plans import catalog
from tests.oracle import connect, same_rows

REGISTRIES = catalog.registries()
QUERIES = {n: q for r in REGISTRIES for n, q in r.queries.items()}
SQL = {n: s for r in REGISTRIES for n, s in r.sql.items()}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        same_rows(df, con, SQL[name])
    else:
        assert df.count() > 0


def test_names_are_not_those_of_problems():
    import re

    assert not [n for n in QUERIES if re.match(r"^(?:op|p)\d+_", n)]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
