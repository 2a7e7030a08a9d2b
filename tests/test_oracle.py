"""Every registered job against its SQL oracle, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracle import frame_hash

from riskframe.plans import queries as Q

ORACLE = entry.oracle_sql()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in ORACLE}


def test_every_query_has_an_oracle():
    assert set(Q.QUERIES) == set(Q.ORACLE) <= set(QUERIES)
    assert set(ORACLE) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert frame_hash(df.columns, srows)[0] == frame_hash(dcols, drows)[0]
