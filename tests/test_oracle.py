"""Every registered query against its DuckDB statement on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.explain_plans import plan_text, summarize
from tools.oracle_check import TABLES, rows_of, type_diffs

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables missing")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# the queries of the order tables; the others are tested with their package
NAMES = sorted(set(E.queries()) - set(E._EXTRA))


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert type_diffs(df, cur) == []
    assert not summarize(plan_text(df))["cartesian"]
    assert got == rows_of(cols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["estado", "total_pedidos"]
    assert df.count() > 0
