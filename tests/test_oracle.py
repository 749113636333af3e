"""Every query against its SQL counterpart."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from ledgerline.plans.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
NAMES = [n for n in oracle_sql() if n in QUERIES]


@pytest.fixture(scope="module")
def duck():
    return check.duck(ROOT)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, ROOT)
    mine = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(oracle_sql()[name])
    theirs = check.rows_of([d[0] for d in cur.description], cur.fetchall())
    assert check.compare(mine, theirs) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 35 and {r.company for r in rows} >= {"ASIA", "EUROPE"}
