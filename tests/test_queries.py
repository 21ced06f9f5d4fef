"""Registered queries at sf0.001: every SQL-checkable query matches its DuckDB oracle."""

import math

import duckdb
import pytest

from encore.plans.registry import oracle_sql, queries
from encore.sources.tables import TABLES

from .conftest import SF_SMALL

FAST_ROWS_ONLY = {"kfold_sizes_hashed", "holdout_draws"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, float(v))
    if isinstance(v, (int, float)):
        return (2, round(float(v), 5)) if not (isinstance(v, float) and math.isnan(v)) else (1, "nan")
    return (3, str(v))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    cols = df.columns
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in df.collect())
    b = sorted(tuple(_norm(r[ocols.index(c)]) for c in order) for r in res.fetchall())
    assert a == b


@pytest.mark.parametrize("name", sorted(FAST_ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert queries()[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - FAST_ROWS_ONLY))
def test_model_queries_run(spark, monkeypatch, name):
    """Every query that SQL cannot express runs whole; tree counts alone are lowered."""
    from encore.plans import q_models

    monkeypatch.setattr(q_models, "TREES", 2)
    monkeypatch.setattr(q_models.K, "FOREST_TREES", 10)
    rows = queries()[name](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        for c, v in r.asDict().items():
            if c in ("rmsle", "mean_rmsle", "error"):
                assert v is not None and 0 <= v < 2, (name, c)
    if name == "gbt_importances":
        assert sum(r.rel_inf for r in rows) == pytest.approx(100.0, abs=1e-3)
    if name.endswith("fold_scores"):
        assert {r.folds for r in rows} == {10}


def test_seasons_are_never_shortened():
    from dataclasses import replace

    from encore.spec import binding_spec, reference_spec

    spec = binding_spec()
    with pytest.raises(ValueError):
        spec.last(7)
    with pytest.raises(ValueError):
        replace(spec, window_years=(2, 8))
    assert reference_spec().windows == (2, 3, 4, 5, 6, 8) and len(reference_spec().last(9)) == 9 and len(reference_spec().composers) == 33


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "account_id" in df.columns
