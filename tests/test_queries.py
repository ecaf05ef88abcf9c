"""Every query against its comparison SQL on the smallest tables."""

import math

import pytest
from conftest import DATA

from rillflow.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 7)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in cur.fetchall())
    assert got == want
    assert want, "a query without rows tells nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())
