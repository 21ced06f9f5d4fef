"""Inputs like the reference's own: text keys, factors of many levels, no scratch setting."""

import pytest
from pyspark.sql import functions as F

from encore.operators.index import with_dense_index


@pytest.mark.parametrize("prefix", ["001i000000Nu", "", "é"])
def test_text_keys_are_numbered_in_order(spark, prefix):
    keys = [f"{prefix}{(i * 7919) % 1000:04x}{'z' * (i % 3)}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = [r.k for r in with_dense_index(df, "k", "n", buckets=7).orderBy("n").collect()]
    assert got == sorted(keys, key=lambda k: k.encode())


def test_trees_take_factors_of_any_width(spark):
    from encore.models.regressors import fit_forest, fit_gbt

    df = spark.createDataFrame([(f"A{i}", f"c{i % 60}", float(i % 7), float(i % 5)) for i in range(300)],
                               "account_id string, city string, x double, total double")
    for fit in (lambda d: fit_gbt(d, trees=2), lambda d: fit_forest(d, trees=2)):
        assert fit(df).predict(df).count() == 300


def test_scratch_folder_without_setting(spark):
    from encore.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_csv_scan_keeps_blanks_and_nulls_apart(spark, tmp_path):
    from encore.sources.files import _scan

    (tmp_path / "t.csv").write_text('account.id,price.level,set\nA1,NA,\nA2,"",x\n')
    rows = [tuple(r) for r in _scan(spark, str(tmp_path / "t.csv")).orderBy("account_id").collect()]
    assert rows == [("A1", None, ""), ("A2", "", "x")]


def test_reduced_rows_follow_the_duplicate_rule(spark):
    from encore.operators.reshape import cast_wide

    cells = [("a", {"s": "1"}, "v"), ("b", {"s": "2"}, "v")]
    once = spark.createDataFrame([(1, "1", 5.0), (1, "2", None), (2, "1", 7.0)], "k long, s string, v double")
    assert sorted(map(tuple, cast_wide(once, "k", cells).collect())) == [(1, 5.0, None), (2, 7.0, None)]
    twice = once.union(spark.createDataFrame([(1, "1", None)], once.schema))
    assert sorted(map(tuple, cast_wide(twice, "k", cells).collect())) == [(1, 2.0, 1.0), (2, 1.0, 0.0)]
