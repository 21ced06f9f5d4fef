"""Operator semantics on hand-made frames: casts, duplicates, adjustments, splits, filters."""

import pytest
from pyspark.sql import functions as F

from encore import constants as K
from encore.operators import adjust as X
from encore.operators.features import drop_matching
from encore.operators.index import with_dense_index
from encore.operators.reshape import cast_wide, melt, pivot_agg
from encore.operators.split import assign_folds, clean_outliers
from encore.spec import binding_spec


def test_cast_wide_single_values_and_zero_fill(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 6.0), (2, "a", 7.0)], "k int, s string, v double")
    cells = [("v_a", {"s": "a"}, "v"), ("v_b", {"s": "b"}, "v")]
    got = {r["k"]: (r["v_a"], r["v_b"]) for r in cast_wide(df, "k", cells).collect()}
    assert got == {1: (5.0, 6.0), 2: (7.0, None)}
    cnt = pivot_agg(df, "k", "s", ["a", "b"], "count")
    assert {r["k"]: (r["a"], r["b"]) for r in cnt.collect()} == {1: (1.0, 1.0), 2: (1.0, 0.0)}


def test_cast_wide_duplicates_turn_every_cell_into_counts(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "a", 6.0), (2, "b", 7.0)], "k int, s string, v double")
    cells = [("v_a", {"s": "a"}, "v"), ("v_b", {"s": "b"}, "v")]
    got = {r["k"]: (r["v_a"], r["v_b"]) for r in cast_wide(df, "k", cells).collect()}
    assert got == {1: (2.0, 0.0), 2: (0.0, 1.0)}
    with pytest.raises(ValueError):
        cast_wide(df, "k", cells, on_duplicate="error")
    first = {r["k"]: r["v_a"] for r in cast_wide(df, "k", cells, on_duplicate="first").collect()}
    assert first[1] == 6.0


def test_melt_then_cast_is_identity_on_unique_keys(spark):
    wide = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, None)], "k int, x double, y double")
    long = melt(wide, ["k"], ["x", "y"])
    back = cast_wide(long, "k", [("x", {"variable": "x"}, "value"), ("y", {"variable": "y"}, "value")])
    assert sorted(map(tuple, back.orderBy("k").collect())) == sorted(map(tuple, wide.collect()))


def test_dense_index_is_1_to_n_in_key_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000 * 3).alias("k")).repartition(5)
    out = with_dense_index(df, "k", "num", buckets=7).orderBy("k").collect()
    assert [r["num"] for r in out] == [float(i) for i in range(1, 1001)]


def test_folds_partition_keys_and_are_stable(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "account_id")
    a = assign_folds(df)
    b = assign_folds(df.repartition(13))
    assert a.select("fold").distinct().count() == K.NUM_FOLDS
    assert a.count() == 5000
    j = a.join(b.withColumnRenamed("fold", "f2"), "account_id")
    assert j.where(F.col("fold") != F.col("f2")).count() == 0


def test_outlier_boundary(spark):
    df = spark.createDataFrame([(1, 4.0, 2.0), (2, 4.5, 2.0)], "account_id int, total double, last double")
    assert [r[0] for r in clean_outliers(df, "last").collect()] == [1]


def test_distance_caps(spark):
    df = spark.createDataFrame([(2.5, 60.0), (2.5, 60.1), (2.5, 300.0), (2.5, 300.1), (2.5, None)], "p double, dSF double")
    got = [r[0] for r in df.select(X.distance_capped(F.col("p"))).collect()]
    assert got == [2.5, 1.0, 1.0, 0.0, 2.5]


def test_inactive_and_invariant(spark):
    spec = binding_spec()
    cols = [f"total_{s.replace('-', '_', 1)}" for s in spec.history_seasons]
    rows = [(0.0,) * 6 + (3.0, ), (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 3.0), (0.0, 0.0, 1.0, 2.0, 0.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", p double")
    got = df.select(X.inactive_zero(F.col("p"), spec), X.invariant_last(F.col("p"), spec)).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (3.0, 1.0), (3.0, 3.0)]


def test_regex_filter_no_match_and_protected(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "account_id int, total double, total_2013_2014 double")
    assert drop_matching(df, "zzz").columns == df.columns
    assert drop_matching(df, "").columns == df.columns
    assert drop_matching(df, "total").columns == ["account_id", "total"]


@pytest.mark.parametrize("rows", [
    [(1, "a", 5.0), (1, "a", 6.0), (2, "b", 7.0)],   # a repeated key: counts everywhere
    [(1, "a", 5.0), (1, "b", 6.0), (2, "b", 7.0)],   # unique keys: values
])
def test_duplicate_check_strategies_agree(spark, rows):
    from encore.operators.reshape import cast_cells
    df = spark.createDataFrame(rows, "k int, s string, v double")
    cells = [(f"v_{x}", F.col("s") == x, "v") for x in ("a", "b")]
    extra = [F.sum("v").alias("sv")]
    outs = []
    for check in ("subquery", "prepass", "checkpoint"):
        r = cast_cells(df, "k", cells, extra, check=check, keys_for_check=["k", "s"])
        outs.append(sorted(tuple(x) for x in r.select("k", "v_a", "v_b", "sv").collect()))
    assert outs[0] == outs[1] == outs[2]


def test_scale_conf_bounds():
    from encore.session import scale_conf
    small = scale_conf(40 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_conf(100e12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000


def test_points_in_polygons_against_brute_force(spark):
    """Rings with holes, notches, shared edges, points on edges and corners, null coordinates."""
    import random

    from encore.operators.polygons import layer_join, polygon_tags

    rings = [("b", [(0, 0), (0, 4), (4, 4), (4, 0)]), ("b", [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]), ("a", [(0, 4), (0, 7), (3, 5.5), (4, 7), (4, 4)]),
             ("c", [(-3.3, -2.1), (5.2, 1.3), (-1.7, 6.4)]), ("d", [(1, 1), (1, 2)])]
    rng = random.Random(3)
    pts = [(i, rng.uniform(-4, 6), rng.uniform(-3, 8)) for i in range(400)]
    pts += [(400 + k, float(y), float(x)) for k, (y, x) in enumerate((y, x) for y in range(-1, 6) for x in range(-1, 8))] + [(900, None, 1.0), (901, 1.0, None)]

    def within(name, y, x):
        odd = False
        for n, ring in rings:
            if n == name and len(ring) >= 3:
                for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1]):
                    if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                        odd = not odd
        return odd

    df = spark.createDataFrame([(i, y, x) for i, y, x in pts], "account_id long, Lat double, Long double")
    r = spark.createDataFrame([(n, [(float(y), float(x)) for y, x in ring]) for n, ring in rings], "polygon_id string, points array<struct<y:double,x:double>>")
    for grid in (0.25, 1.0, 3.0):
        tagged = polygon_tags(df, r, grid)
        got = {t.account_id: t.polygon_id for t in tagged.collect()}
        want = {i: next((n for n in "abcd" if y is not None and x is not None and within(n, y, x)), None) for i, y, x in pts}
        assert got == want and len(set(want.values())) == 4
    both = layer_join(df.select("account_id"), tagged.where("account_id < 10").select("account_id", "polygon_id")).collect()
    assert len(both) == len(pts) and all((t.layer_polygon_id is not None) <= (t.account_id < 10) for t in both)


def test_heat_is_the_same_at_any_number_of_rows(spark):
    from encore.operators.polygons import heat_surface, heat_tags

    pts = [(37.1, -122.1)] * 5 + [(37.3, -122.1)] * 3 + [(40.0, -100.0)] * 2
    df = spark.createDataFrame(pts, "Lat double, Long double")
    heat = {(r.cell_y, r.cell_x): r.heat for r in heat_surface(df, 0.25, 1.0).collect()}
    # the cell of the five: its own, and the three of the next cell at a quarter of the radius
    assert heat[148, -489] == pytest.approx(5 + 3 * (1 - 0.0625) ** 2)
    more = df.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(100))))
    one, many = ({(r.Lat, r.hotspot) for r in heat_tags(d, 0.5).collect()} for d in (df, more))
    assert one == many == {(37.1, "Yes"), (37.3, "Yes"), (40.0, None)}


def test_cells_looked_up_in_a_map_equal_conditional_aggregates(spark):
    from encore.operators.reshape import cast_cells, cell

    rows = [(1, "a", "0", 2.0, "x"), (1, "a", "1", 3.0, None), (1, "z", "1", 9.0, "q"), (2, "b", "1", None, "y"), (2, None, "1", 5.0, "n"), (3, "b\u00011", "", 7.0, "s")]
    for more, counted in (([], False), ([(1, "a", "0", 4.0, "w")], True)):
        df = spark.createDataFrame(rows + more, "k long, s string, t string, v double, w string")
        names = [(f"{v}_{s}_{t}", {"s": s, "t": t}, v) for v in ("v", "w") for s in ("a", "b") for t in ("0", "1")]
        extra = [F.sum("__seen").alias("seen")]
        for how in (dict(check="subquery"), dict(check="prepass"), dict(check="checkpoint"), dict(on_duplicate="first")):
            both = [cast_cells(df, "k", cells, extra, keys_for_check=["k", "s", "t"], by_cell=[F.count("v").alias("__seen")], **how)
                    for cells in (names, [(n, cell(m), v) for n, m, v in names])]
            a, b = (sorted(map(tuple, d.select("k", *[n for n, _, _ in names], "seen").collect())) for d in both)
            assert a == b and both[0].dtypes == both[1].dtypes
    assert "max(CASE" not in both[0]._jdf.queryExecution().toString()
