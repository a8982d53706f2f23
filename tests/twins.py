"""Compare a query with its SQL twin on DuckDB."""

import glob
import os
import re

import duckdb


def connection(data):
    con = duckdb.connect()
    for p in sorted(glob.glob(f"{data}/*.parquet")):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(x):
    if isinstance(x, dict):
        return str({k: plain(v) for k, v in x.items()})
    if isinstance(x, (list, tuple)):
        return str([plain(v) for v in x])
    return repr(round(x, 9)) if isinstance(x, float) else "~" if x is None else str(x)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(v[i]) for i in order) for v in values)


#: No products, no Python row at a time.
BARRED = "CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython"


def assert_equal(spark, con, data, query, sql, barred=BARRED):
    """The rows of a query and of its SQL, and what must not be in its plan."""
    df = query(spark, data)
    assert not re.search(barred, df._jdf.queryExecution().executedPlan().toString())
    got = rows(df.columns, [tuple(r.asDict(True).values()) for r in df.collect()])
    want = con.sql(sql)
    assert got == rows(want.columns, want.fetchall())
