"""Every SQL-checkable key against its DuckDB oracle on the smallest data
set (the driver runs the same comparison at sf0.01)."""

import math
import os

import pytest

import __spark_entry__ as entry

from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SLOW = {k for k in entry.oracle_sql() if k.startswith("stream_")} | {"compact_fact"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime as dt

    import pandas as pd

    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT:
        return None
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None)
        return v.date() if v.time() == dt.time(0) else v
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_matches_oracle(spark, duck, name):
    got = _rows(entry.queries()[name](spark, SF001).toPandas())
    want = _rows(duck.execute(entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
