"""Queries with SQL against DuckDB, over whole tables."""

import os
from pathlib import Path

import pytest

from tallyspan.llm import lm, queries
from tests.test_queries import rows

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not Path(DATA).is_dir():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_base_scores_build_no_filter(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, t) for i, t in enumerate(["a b a", "B c", None, "", "a a b"] * 4)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    full = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in queries.QUERIES["op6_lm_scoring"](spark, str(tmp_path)).collect()}
    monkeypatch.setattr(lm, "build_filter", None)
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in queries.QUERIES["lm_base_scores"](spark, str(tmp_path)).collect()}
    assert got == full
