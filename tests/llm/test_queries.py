"""Every query of the problems runs over the smallest tables; those with SQL give the same rows."""

import pytest

from loamline.llm import catalog
from tests.oracle import connect, same_rows

QUERIES = {n: q for r in catalog.registries() for n, q in r.queries.items()}
SQL = {n: s for r in catalog.registries() for n, s in r.sql.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        same_rows(df, connect(sf), SQL[name])
    else:
        df.count()


@pytest.mark.parametrize("n, columns", [(1, ["name"]), (2, ["rec_a", "rec_b"]), (3, ["rec_id", "kind"]), (4, ["tbl", "row_id", "field", "defect"]), (5, ["rec_a", "rec_b"]), (6, ["doc_id"]), (7, ["doc_id", "question_id"]), (8, ["doc_id", "lang"])])
def test_found_has_the_columns_asked_for(spark, sf, n, columns):
    assert QUERIES[f"p{n}_found"](spark, sf).columns == columns
