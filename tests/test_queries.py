"""Every query of the library itself against its SQL on DuckDB, over whole tables."""

import math
import os
import re
from pathlib import Path

import pandas as pd
import pytest

from tallyspan.plans import registry

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
registry.load()


def rows(df):
    df = df[sorted(df.columns)]
    plain = lambda v: None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)) else float(round(v, 9)) + 0.0 if isinstance(v, float) else v
    out = []
    for r in df.astype(object).itertuples(index=False, name=None):
        out.append(tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in map(plain, r)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not Path(DATA).is_dir():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_its_sql_and_reads_whole_tables():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert len(registry.QUERIES) > 150
    for name, sql in registry.ORACLES.items():
        assert not re.search(r"tablesample|using sample", sql, re.I), name
