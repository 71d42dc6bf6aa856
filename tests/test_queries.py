"""Every registered driver query against its DuckDB oracle on the smallest scale."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark"]
# the corpus queries are tested in tests/llm, those with SQL also here
CORPUS = {n for n in entry.queries() if n == "pipeline" or re.match(r"op\d+_", n)}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _sorted(rs):
    return sorted(rs, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(entry.queries()) - CORPUS == set(entry.oracle_sql()) - CORPUS
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["stay_id", "finess_geo", "person_id", "stay_start_date", "stay_end_date"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = _sorted([tuple(_norm(r[i]) for i in idx) for r in res.fetchall()])
    assert got == want
