"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from genrec.plans import catalog, oracle
from tests.conftest import SF001
from tools_compare import TABLES, norm

# trained factors have no SQL: tests/test_factors.py
NO_SQL = {"als_top_n"}
NAMES = sorted(set(catalog.queries()) - NO_SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.fixture(scope="module", autouse=True)
def shared_stages():
    """Queries over the same tables share their written stages; each has its own in use."""
    made, real = {}, catalog._Ctx
    with pytest.MonkeyPatch.context() as m:
        m.setattr(catalog, "_Ctx", lambda *a: made.setdefault(a[1:], None) or made.update({a[1:]: real(*a)}) or made[a[1:]])
        yield


def test_every_query_has_sql():
    assert set(oracle.oracle_sql()) == set(NAMES)
    assert set(catalog.queries()) <= set(E.queries())


# operators the plan review removed or never allowed (PLANS.md)
FORBIDDEN = ("SortAggregate", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = df.toPandas()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan
    exp = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    cols = sorted(got.columns)
    g = sorted(tuple(norm(r[c]) for c in cols) for _, r in got.astype(object).iterrows())
    e = sorted(tuple(norm(r[c]) for c in cols) for _, r in exp.astype(object).iterrows())
    assert g == e


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["userid", "movieid", "score", "rank"]
    assert df.count() > 0
