"""The driver contract, and the oracle comparison for a sample of queries at
sf0.001 (the full comparison at sf0.01 is ``tools/oracle_check.py``)."""

import importlib.util
import math
import os

import duckdb
import pytest

from tests.conftest import ROOT, SF001
from tidewater.sources.tables import SCHEMAS

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

SAMPLE = ["follows_summary", "auth_attempts_by_user", "auth_top_ips", "sparql_programmes",
          "corpus_license_counts", "annot_merge_votes", "sketch_registers_partkey", "vec_centroid_nn",
          "geo_nearest", "eval_report", "tree_best_split_gini", "ml_normal_equations"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return "NULL" if v is None else str(v)


def _canon(cols, rows_):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows_)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "user" in df.columns


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry_mod.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got == want
