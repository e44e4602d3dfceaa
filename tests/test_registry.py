"""Registry contract: entry() smoke run, every query has an oracle, and every
query equals its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from rentscope.plans import catalog  # noqa: E402
from oracle_check import canon  # noqa: E402
from rentscope.sources.tables import TABLES  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


def test_queries_equal_oracle_small(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    bad, crossed = [], []
    for name, fn in sorted(catalog.queries().items()):
        df = fn(spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            crossed.append(name)
        srows, scols = [tuple(r) for r in df.collect()], df.columns
        res = con.execute(catalog.oracle_sql()[name])
        dcols, drows = [d[0] for d in res.description], res.fetchall()
        if sorted(scols) != sorted(dcols) or canon(scols, srows) != canon(dcols, drows):
            bad.append(name)
    assert not bad, bad
    assert not crossed, crossed  # no cross products / nested-loop joins anywhere
