"""Every query with SQL against DuckDB on the smallest tables; every other one runs."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def norm(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and np.isnan(x)):
        return ""
    return repr(round(float(x), 8)) if isinstance(x, (int, float, np.number)) and not isinstance(x, bool) else str(x)


def core_names():
    from threadloom import queries as core

    return sorted(core.queries())


@needs_data
@pytest.mark.parametrize("name", core_names())
def test_query(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(sql).fetchdf()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda d: sorted(tuple(map(norm, r)) for r in d[cols].itertuples(index=False))
    assert rows(got) == rows(want)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_nothing_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(root, "threadloom")):
        if os.sep + "llm" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                assert "threadloom.llm" not in open(os.path.join(folder, f), encoding="utf-8").read(), f
