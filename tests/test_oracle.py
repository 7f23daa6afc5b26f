"""Registered queries of every family agree with DuckDB at sf0.001; ``tools/check_oracle.py``
compares all of them."""

import math

import duckdb
import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem", "events", "customer"]
FAST = ["shop_events", "category_map", "sessions_all", "monthly_merge", "session_main_cat", "stratified_split",
        "roc_auc", "average_precision", "feature_summary", "crosstab_purity", "classification_report",
        "univariate_auc", "spot_recompute", "session_sample", "sessions_wide", "log1p_hist", "quantile_cut",
        "windowed_sessions", "incremental_sessions", "scan_csv", "fill_missing", "column_presence", "dtype_report",
        "metrics_upsert", "write_sessions", "attach_month_missing", "audit_report"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v


def _canon(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF)
    r = con.execute(ent.oracle_sql()[name])
    ocols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = [tuple(row[ocols.index(c)] for c in df.columns) for row in r.fetchall()]
    assert _canon([tuple(x) for x in df.collect()]) == _canon(orows)


def test_every_oracle_key_is_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "cart_to_view_ratio" in df.columns
