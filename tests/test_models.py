"""Models: KNN against numpy brute force, LDA sanity, t-loss gradient, search rules."""

import random

import numpy as np
from pyspark.sql import functions as F
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from encore import constants as K
from encore.models.knn import knn_vote
from encore.models.boosting import gradient
from encore.search.random_search import budget_exceeded, draw_trials


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    xt = rng.normal(size=(300, 4))
    yt = rng.integers(0, 4, size=300).astype(float)
    xq = rng.normal(size=(40, 4))
    train = spark.createDataFrame([(Vectors.dense(x), float(y)) for x, y in zip(xt, yt)], ["scaled", "total"])
    qs = spark.createDataFrame([(i, Vectors.dense(x)) for i, x in enumerate(xq)], ["query_id", "scaled"])
    got = {r["query_id"]: r["prediction"] for r in knn_vote(train.repartition(3), qs, k=3, block_rows=70).collect()}
    for i, q in enumerate(xq):
        d = ((xt - q) ** 2).sum(1)
        order = sorted(range(len(d)), key=lambda j: (d[j], yt[j]))[:3]
        labels = [yt[j] for j in order]
        counts = {l: labels.count(l) for l in labels}
        want = sorted(counts, key=lambda l: (-counts[l], l))[0]
        assert got[i] == want


def test_t_gradient_matches_finite_difference():
    df, y, f, h = 8.0, 3.0, 1.2, 1e-6
    loss = lambda ff: (df + 1) / 2 * np.log(1 + (y - ff) ** 2 / df)
    num = -(loss(f + h) - loss(f - h)) / (2 * h)
    assert gradient("tdist", np.array([y - f]), df)[0] == pytest.approx(num, rel=1e-5)


def test_budget_rule_and_draws():
    assert budget_exceeded(6000, 6, 10)
    assert not budget_exceeded(6000, 6, 30)
    assert not budget_exceeded(4000, 9, 1)
    trials = draw_trials(50, seed=5, filter_override=None)
    assert all(not budget_exceeded(t.trees, t.depth, t.n_tokens) for t in trials)
    assert all(t.filter.startswith(K.SEARCH_START_FILTER) for t in trials)
    assert draw_trials(3, seed=5) == draw_trials(3, seed=5)


def test_gbt_is_seed_stable(spark):
    from encore.models import regressors as R
    from encore.operators import evaluate as E
    from encore.operators.features import build_features, drop_matching
    from encore.operators.split import assign_folds, clean_outliers, prepare_training, split
    from encore.sources.bind import read_bundle
    from .conftest import SF_SMALL
    b = read_bundle(spark, SF_SMALL)
    train = assign_folds(prepare_training(b.labels, build_features(b))).cache()
    tr, va = split(train, 1)

    def score():
        m = R.fit_gbt(drop_matching(clean_outliers(tr, "total_2013_2014"), K.FILTER_GBM), trees=15, shrinkage=0.1,
                      depth=3)
        p = m.predict(va).join(va.select("account_id", "total"), "account_id")
        return E.rmsle(p).first()["rmsle"]

    assert score() == pytest.approx(score(), rel=1e-12)  # same model; only the summation order may differ


def test_gbt_beats_carry_forward_on_planted_signal(spark):
    from encore.models import regressors as R
    from encore.operators import evaluate as E
    rng = np.random.default_rng(11)
    n = 3000
    x, z = rng.uniform(0, 4, n), rng.uniform(0, 4, n)
    y = np.floor(x)                      # label planted in x
    last = np.floor(z)                   # "last season" unrelated to the label
    rows = [(i, float(y[i]), float(x[i]), float(last[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "account_id long, total double, x double, total_2013_2014 double")
    tr, va = df.where("account_id % 5 <> 0"), df.where("account_id % 5 = 0")
    m = R.fit_gbt(tr, trees=30, shrinkage=0.3, depth=3)
    p = m.predict(va).join(va.select("account_id", "total"), "account_id")
    model = E.rmsle(p).first()["rmsle"]
    base = E.rmsle(va.select("account_id", "total", F.col("total_2013_2014").alias("prediction"))).first()["rmsle"]
    assert model < 0.5 * base


def _planted(n=240, seed=0):
    """Rows with whole numbers, a factor and heavy-tailed noise; labels on a grid of tenths."""
    rng = np.random.default_rng(seed)
    x, lev = rng.integers(0, 20, (n, 3)).astype(float), rng.integers(0, 9, n)
    y = np.round(np.where(x[:, 0] > 9, 2.0, 0) + 0.3 * x[:, 1] + (lev % 3) + rng.standard_t(2, n), 1)
    rows = [(i, float(y[i]), *map(float, x[i]), f"l{lev[i]}" if lev[i] else None, i % 3) for i in range(n)]
    return x, lev, y, rows, "account_id long, total double, a double, b double, c double, city string, fold int"


def _boost_by_hand(x, lev, y, rows, spec):
    """Best-first boosting with exact leaf values, in numpy."""
    from encore.models import boosting as B

    name = lambda v: f"l{v}" if v else ""
    means = {v: y[rows][lev[rows] == v].mean() for v in set(lev[rows])}
    order = {v: i for i, v in enumerate(sorted(means, key=lambda v: (means[v], name(v))))}
    x = np.concatenate([x, np.array([order[v] for v in lev])[:, None]], axis=1)
    one = lambda c: np.ones(len(c))
    f = np.full(len(y), B.location(spec.loss, y[rows], one(rows), spec.df))

    def best(g, c):
        top = (0.0, 0, 0.0)
        for j in range(x.shape[1]):
            for v in np.unique(x[c, j])[:-1]:
                left = x[c, j] <= v
                n = left.sum()
                if min(n, len(c) - n) >= spec.minobsinnode:
                    a, b = g[c][left].sum(), g[c][~left].sum()
                    gain = a * a / n + b * b / (len(c) - n) - (a + b) ** 2 / len(c)
                    top = (gain, j, v) if gain > top[0] + 1e-9 else top
        return top

    for _ in range(spec.trees):
        g, new = B.gradient(spec.loss, y - f, spec.df), f.copy()
        leaves = [(best(g, rows), rows, np.arange(len(y)))]
        for _ in range(spec.splits):
            k = max(range(len(leaves)), key=lambda i: leaves[i][0][0])
            (gain, j, v), c, e = leaves[k]
            if gain <= 0:
                break
            leaves[k:k + 1] = [(best(g, c[m]), c[m], e[w]) for m, w in ((x[c, j] <= v, x[e, j] <= v), (x[c, j] > v, x[e, j] > v))]
        for _, c, e in leaves:
            new[e] += spec.shrinkage * B.location(spec.loss, (y - f)[c], one(c), spec.df)
        f = new
    return f


def test_boosting_of_many_models_equals_numpy(spark):
    from encore.models import boosting as B

    x, lev, y, rows, schema = _planted()
    df = spark.createDataFrame(rows, schema)
    specs = [B.Spec(5, 0.3, 1.0, 4, 5, loss, 8.0, out) for loss in B.LOSSES for out in (-1, 1)]
    m = B.fit_boosted(df.repartition(3), specs)
    for i, s in enumerate(specs):
        got = {r.account_id: r.prediction for r in m.predict(df, i).collect()}
        want = _boost_by_hand(x, lev, y, np.flatnonzero(np.arange(len(y)) % 3 != s.out), s)
        assert np.allclose([got[k] for k in range(len(y))], want, atol=2e-3), s
    assert all(sum(v for _, v in m.influence(i)) == pytest.approx(100.0) for i in range(len(specs)))
    # out of fold: every row by the model of its fold
    both = m.predict(df, F.when(F.col("fold") == 1, 1).otherwise(0), ("account_id", "fold")).collect()
    one = {r.account_id: r.prediction for r in m.predict(df, 1).collect()}
    assert all(r.prediction == one[r.account_id] for r in both if r.fold == 1)


def test_bags_follow_from_keys_alone(spark):
    from encore.models import boosting as B

    _, _, _, rows, schema = _planted(400, 1)
    df = spark.createDataFrame(rows, schema)
    spec = B.Spec(30, 0.2, 0.5, 3, 5, "tdist")
    a, b = (B.fit_boosted(d, [spec]).predict(df).orderBy("account_id").toPandas().prediction for d in (df.repartition(2), df.repartition(7)))
    assert np.allclose(a, b) and len(set(np.round(a, 6))) > 20
    h = np.arange(10_000, dtype=np.int64) * 7919
    share = [B.drawn(h, 3, t, 0.5) for t in range(2)]
    assert all(abs(s.mean() - 0.5) < 0.03 for s in share) and abs((share[0] == share[1]).mean() - 0.5) < 0.03


def test_a_thousand_trees_score_in_one_pass(spark):
    from encore.models import boosting as B

    rng = np.random.default_rng(3)
    trees = B.Trees()
    for _ in range(1000):
        c = rng.integers(0, 40, 3).tolist()
        trees = trees.plus([{"feature": 0, "cut": c[0], "left": 1, "right": 2}, {"value": 0.01}, {"feature": 1, "cut": c[1], "left": 3, "right": 4},
                            {"value": -0.02}, {"value": 0.03}])
    edges = [np.arange(40.0), np.arange(40.0)]
    m = B.Boosted([B.Spec(1000)], ["a", "b"], [], edges, None, np.zeros((0, 1)), [1.0], [trees], [{}])
    v = rng.integers(0, 41, (500, 2)).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(v)], "account_id long, a double, b double")
    got = m.predict(df).orderBy("account_id").toPandas().prediction
    cut = trees.cut.reshape(1000, 5)
    want = 1 + np.where(v[:, :1] <= cut[:, 0], 0.01, np.where(v[:, 1:] <= cut[:, 2], -0.02, 0.03)).sum(axis=1)
    assert np.allclose(got, want)
    assert m.predict(df)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2  # bins, scores


def test_wide_factors_stay_off_the_driver(spark):
    from encore.models import boosting as B
    from encore.models.levels import level_table

    df = spark.range(40_000).select("id", F.format_string("city%05d", F.col("id") % 20_000).alias("city"), ((F.col("id") % 20_000) / 5000).alias("total"))
    table = level_table(df, ["city"], "total").toPandas().sort_values("number")
    assert table.number.tolist() == list(range(20_000)) and table.level.tolist() == [f"city{i:05d}" for i in range(20_000)]
    m = B.fit_boosted(df.withColumnRenamed("id", "account_id"), [B.Spec(3, 0.5, 1.0, 8)])
    err = m.predict(df.withColumnRenamed("id", "account_id"), keep=("account_id", "total")).agg(F.avg(F.pow(F.col("prediction") - F.col("total"), 2))).first()[0]
    assert err < 0.1 * (4 ** 2 / 12)


def test_linear_folds_equal_separate_fits(spark):
    from encore.models.gram import fit_linear_folds, fit_linear_holdouts

    x, lev, y, rows, schema = _planted()
    df = spark.createDataFrame(rows, schema).repartition(4)
    names = [f"l{v}" if v else "" for v in lev]
    means = {v: y[[n == v for n in names]].mean() for v in set(names)}
    order = sorted(means, key=lambda v: (means[v], v))
    d = np.concatenate([np.ones((len(y), 1)), x, np.array([[float(n == v) for v in order[1:]] for n in names])], axis=1)
    m = fit_linear_folds(df)
    for out in (-1, 0, 1, 2):
        use = np.arange(len(y)) % 3 != out
        want = np.linalg.lstsq(d[use], y[use], rcond=None)[0]
        assert np.allclose([m.solutions[out][0], *m.solutions[out][1]], want, atol=1e-6)
    got = m.predict(df, F.lit(1)).orderBy("account_id").toPandas().prediction
    want = np.linalg.lstsq(d[np.arange(len(y)) % 3 != 1], y[np.arange(len(y)) % 3 != 1], rcond=None)[0]
    assert np.allclose(got, d @ want, atol=1e-6)
    held = fit_linear_holdouts(df.drop("fold"), [F.col("account_id") % 2 == 0, F.col("account_id") < 100], F.col("total") < 8)
    for i, out in enumerate((np.arange(len(y)) % 2 == 0, np.arange(len(y)) < 100)):
        use = ~out & (y < 8)
        assert np.allclose([held.solutions[i][0], *held.solutions[i][1]], np.linalg.lstsq(d[use], y[use], rcond=None)[0], atol=1e-6)


def test_scaled_columns(spark):
    from encore.models.gram import scaled

    _, _, _, rows, schema = _planted()
    df = spark.createDataFrame(rows, schema).withColumn("same", F.lit(3.0))
    z, names = scaled(df, keep=("account_id",), fit_on=F.col("fold") != 0)
    got = np.array([r.scaled for r in z.orderBy("account_id").collect()])
    a = np.array([r[2] for r in rows])
    fit = a[[r[-1] != 0 for r in rows]]
    assert names[:3] == ["a", "b", "c"] and "same" not in names and np.allclose(got[:, 0], (a - fit.mean()) / fit.std(ddof=1))


def test_bessel_function():
    from math import factorial

    from encore.models.machines import bessel_ratio

    # J_0(1), J_0(10), J_1(2), J_10(15), J_10(40)
    known = {(0, 1.0): 0.7651976865579666, (0, 10.0): -0.2459357644513483, (1, 2.0): 0.5767248077568734,
             (10, 15.0): -0.09007181104765905, (10, 40.0): 0.11938336278226095}
    for (order, z), j in known.items():
        assert bessel_ratio(np.array([z]), order)[0] == pytest.approx(j / z ** order * factorial(order) * 2 ** order, rel=1e-9)
    assert bessel_ratio(np.array([0.0]), 10)[0] == 1.0
    near = bessel_ratio(np.array([17.999, 18.001]), 10)  # both ways meet
    assert near[0] == pytest.approx(near[1], rel=5e-2)


def test_nystroem_map_is_near_the_kernel():
    from encore.models.machines import Kernel, Nystroem

    x = np.random.default_rng(0).normal(size=(200, 20))
    for kernel, most, mean in ((Kernel("bessel", 0.01), 1e-6, 1e-7), (Kernel("bessel", 0.25, 2), 0.1, 5e-3), (Kernel("radial", 0.01), 0.3, 2e-2)):
        phi = Nystroem.fit(kernel, x[:100])(x)[:, :-1]
        off = np.abs(phi @ phi.T - kernel(x, x))
        assert off.max() < most and off.mean() < mean and off[:100, :100].max() < 1e-3


def test_machines_reach_the_least_loss(spark):
    from encore.models.machines import Kernel, Machine, fit_machines

    rng = np.random.default_rng(0)
    x = rng.normal(size=(150, 4))
    y = np.round(np.sin(x[:, 0]) * 2 + x[:, 1] ** 2, 1)
    c = (x[:, 2] > 0).astype(float)
    df = spark.createDataFrame([(i, float(y[i]), float(c[i]), i % 3, x[i].tolist()) for i in range(150)],
                               "account_id long, total double, kind double, fold int, scaled array<double>")
    kernel = Kernel("radial", 0.1)
    phi = np.concatenate([np.linalg.cholesky(kernel(x, x) + 1e-9 * np.eye(150)), np.ones((150, 1))], axis=1)
    for label, target, machines in (("total", y, [Machine(0, "regression", 10.0, 0.1, o) for o in (-1, 1)]), ("kind", c, [Machine(0, "class", 5.0, positive=1.0)])):
        m = fit_machines(df.repartition(3), [kernel], machines, label=label, n_landmarks=150, tolerance=1e-4)
        for i, one in enumerate(machines):
            use, w, ridge = np.arange(150) % 3 != one.out, np.zeros(151), np.diag([1.0] * 150 + [1e-9])
            for _ in range(300):
                weight, t, _ = one.step(target[use], phi[use] @ w)
                w = np.linalg.solve(phi[use].T @ (phi[use] * weight[:, None]) + ridge, phi[use].T @ (weight * t))
            least = 0.5 * w[:-1] @ w[:-1] + one.step(target[use], phi[use] @ w)[2]
            assert m.losses[i][-1] <= least * 1.02 and all(b <= a + 1e-6 for a, b in zip(m.losses[i][1:], m.losses[i][2:]))


def test_importances_of_library_trees_sum_to_a_hundred(spark):
    from encore.models import regressors as R

    _, _, _, rows, schema = _planted()
    df = spark.createDataFrame(rows, schema).drop("fold")
    for m in (R.fit_gbt(df, trees=3), R.fit_forest(df, trees=3)):
        imp = R.importances(m, df)
        assert sum(v for _, v in imp) == pytest.approx(100.0) and {n for n, _ in imp} <= {"a", "b", "c", "city"}


def test_knn_leaves_out_the_own_fold(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(120, 3)), rng.integers(0, 3, 120).astype(float)
    df = spark.createDataFrame([(i, float(y[i]), i % 4, x[i].tolist()) for i in range(120)], "account_id long, total double, fold int, vec array<double>")
    q = df.select(F.col("account_id").alias("query_id"), "fold", "vec")
    got = {r.query_id: r.prediction for r in knn_vote(df, q, vec="vec", apart="fold", block_rows=25, keep=("fold",)).collect()}
    for i in range(120):
        near = sorted((float(((x[i] - x[j]) ** 2).sum()), y[j]) for j in range(120) if j % 4 != i % 4)[:3]
        votes = [v for _, v in near]
        assert got[i] == min(set(votes), key=lambda v: (-votes.count(v), v))


def test_search_resumes_from_its_table(spark, tmp_path):
    from encore.search.random_search import run_search
    from encore.spec import binding_spec, suffix

    rng = np.random.default_rng(8)
    spec = binding_spec()
    totals = [f"total_{suffix(s)}" for s in spec.history_seasons]
    rows = [(i, float(v[-1]), i % 3 + 1, *map(float, v), "CA", 1.0) for i, v in enumerate(rng.integers(0, 4, (150, 6)))]
    df = spark.createDataFrame(rows, "account_id long, total double, fold int, " + ", ".join(f"{t} double" for t in totals) + ", State string, dSF double")
    how = dict(n_trials=3, seed=4, folds=[1, 2, 3], tree_budget=1 / 1000, step_scale=100.0, filter_override="none", abandon_above=10.0, threshold=10.0)
    whole = run_search(df, spec, trial_table=str(tmp_path / "a"), **how)
    assert whole.count() == 3 and whole.where("accept_raw").count() == 3
    calls = []

    def killed(n):
        calls.append(n)
        if n == 1:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        run_search(df, spec, trial_table=str(tmp_path / "b"), before=killed, **how)
    calls.clear()
    again = run_search(df, spec, trial_table=str(tmp_path / "b"), before=calls.append, **how)
    assert calls == [1, 2]  # the finished trial is not run again
    a, b = (d.orderBy("trial").toPandas() for d in (whole, again))
    assert np.allclose(a.mean_raw, b.mean_raw) and (a.drop(columns=["mean_raw", "sum_raw", "mean_inactive", "mean_invariant"])
                                                    == b.drop(columns=["mean_raw", "sum_raw", "mean_inactive", "mean_invariant"])).all().all()
    # a bad first fold ends a trial
    bad = run_search(df, spec, trial_table=str(tmp_path / "c"), **(how | {"abandon_above": 0.0, "n_trials": 1})).collect()
    assert bad[0].abandoned and not bad[0].accept_raw


def test_lda_of_all_folds_equals_separate_fits(spark):
    from encore.models.lda import fit_lda_folds

    rng = np.random.default_rng(4)
    n = 600
    x = rng.normal(size=(n, 3))
    y, f = (rng.integers(0, 3, n) + (x[:, 0] > 0.5)).astype(float), rng.integers(1, 4, n)
    y[f == 2] = np.minimum(y[f == 2], 2.0)
    y[0], f[0], x[:, 2] = 9.0, 3, np.where(f == 1, x[:, 2], 7.0)  # a class of one fold alone; a column that varies in one fold alone
    df = spark.createDataFrame([(i, float(y[i]), int(f[i]), *map(float, x[i])) for i in range(n)], "account_id long, total double, fold int, a double, b double, c double")
    got = {r.account_id: r.prediction for r in fit_lda_folds(df.repartition(3)).predict(df, F.col("fold")).collect()}
    for k in (1, 2, 3):
        use = f != k
        cols = [0, 1] if k == 1 else [0, 1, 2]
        z, t = x[use][:, cols], y[use]
        classes = np.unique(t)
        m = np.stack([z[t == c].mean(axis=0) for c in classes])
        d = z - m[np.searchsorted(classes, t)]
        w = np.linalg.solve(d.T @ d / (len(t) - len(classes)) + 1e-6 * np.eye(len(cols)), m.T).T
        s = x[~use][:, cols] @ w.T - 0.5 * (m * w).sum(axis=1) + np.log([(t == c).mean() for c in classes])
        assert [got[i] for i in np.flatnonzero(~use)] == classes[s.argmax(axis=1)].tolist()


def test_knn_of_copies_and_ties_equals_brute_force(spark):
    from encore.models import knn

    rng = np.random.default_rng(9)
    x, y, g = rng.integers(0, 3, (4000, 2)).astype(float), rng.integers(0, 3, 4000).astype(float), rng.integers(0, 4, 4000)
    x[0] = [-0.0, 0.0]
    df = spark.createDataFrame([(i, float(y[i]), int(g[i]), x[i].tolist()) for i in range(4000)], "account_id long, total double, fold int, vec array<double>")
    got = {r.query_id: r.prediction for r in knn_vote(df, df.select(F.col("account_id").alias("query_id"), "fold", "vec"), vec="vec", apart="fold", block_rows=40).collect()}
    for i in range(0, 4000, 37):
        near = sorted(zip(((x[i] - x) ** 2).sum(1)[g != g[i]], y[g != g[i]]))[:3]
        votes = [v for _, v in near]
        assert got[i] == min(set(votes), key=lambda v: (-votes.count(v), v))
    # far from the origin, where products of matrices cancel: distances as sums of squares, in the same order
    x = 1e6 + rng.normal(size=(3000, 5)) * 1e-3
    y = rng.integers(0, 3, 3000).astype(float)
    i, label, d2 = knn.nearest_rows(x[:50], x, y, 3)
    for q in range(50):
        want = sorted(zip(((x[q] - x) ** 2).sum(1), y))[:3]
        assert np.allclose(d2[i == q], [w[0] for w in want]) and label[i == q].tolist() == [w[1] for w in want]


def test_boosting_packs_rows_by_feature(spark):
    from encore.models import boosting as B

    x = np.random.default_rng(2).integers(0, 9, (3, 50)).astype(np.uint8)
    t = B.Trees().plus([{"feature": 2, "cut": 4, "left": 1, "right": 2}, {"value": 0.5}, {"feature": 0, "cut": 3, "left": 3, "right": 4}, {"value": -1.0}, {"value": 2.0}])
    want = np.where(x[2] <= 4, 0.5, np.where(x[0] <= 3, -1.0, 2.0))
    assert np.array_equal(t.plus([{"value": 0.25}]).score(list(x), 50), want + 0.25) and set(t.nodes(list(x), 50)) <= {1, 3, 4}
    rows = B.Rows(2, 50, np.arange(50).tobytes(), np.ones(50).tobytes(), np.zeros(50, np.int32).tobytes(), x.tobytes(), x.tobytes() * 2, np.zeros((2, 50)).tobytes())
    assert len(rows.of(1)) == 6 and np.array_equal(rows.of(1)[5], x[2])
    assert not rows.active(B.Spec(out=0, bagfrac=1.0), 0).any() and rows.active(B.Spec(out=1, bagfrac=1.0), 0).all()


def test_machine_rows_are_packed_whole():
    import pyarrow as pa

    from encore.models import machines as M

    n, x = M.BLOCK + 3, np.random.default_rng(1).normal(size=(M.BLOCK + 3, 2))
    b = pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array(np.arange(float(n))), pa.array(np.arange(n) % 5, pa.int32())], ["v", "y", "fold"])
    got = [r for p in M._packed(iter([b.slice(1)])) for r in p.to_pylist()]
    assert len(got) == 2 and np.array_equal(np.concatenate([np.frombuffer(r["v"]) for r in got]).reshape(-1, 2), x[1:])
    assert np.array_equal(np.concatenate([np.frombuffer(r["y"]) for r in got]), np.arange(1.0, n))
    assert np.array_equal(np.concatenate([np.frombuffer(r["fold"], np.int32) for r in got]), np.arange(1, n) % 5)


def _fold_rows(spark, n=500, seed=4):
    """Numbers, a constant, a number that varies in fold 1 alone, and a factor with a blank level and one that only fold 1 has."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        fold, a, b = i % 4 + 1, float(rng.normal()), float(rng.normal(3, 2))
        level = ["", "p", "q", "only"][int(rng.integers(0, 4 if fold == 1 else 3))]
        y = float(np.clip(round(1 + a + 0.3 * b - (level == "p") + 0.5 * rng.standard_t(3)), 0, 4))
        rows.append((i, fold, a, b, 2.0, float(fold == 1) * a, level, y))
    return spark.createDataFrame(rows, "account_id long, fold int, a double, b double, same double, alone double, kind string, total double").repartition(3)


def _jobs(spark, run, group):
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    spark.sparkContext.setJobGroup("after", "after")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_class_folds_reach_the_hinge_loss_in_shared_passes(spark):
    from pyspark.ml.classification import LinearSVC
    from encore.models.fourier import fit_class_folds, fourier_folds
    from encore.models.kernels import fourier_features
    from encore.models.regressors import _kernel_design
    from encore.search.cv import class_folds
    df = _fold_rows(spark).cache()
    data = fourier_folds(df, [1, 2, 3, 4], 0.05, 12)
    classes = [float(c) for c in range(5)]
    m, losses = fit_class_folds(data, {f: classes for f in data.folds}, 0.01)
    train = df.where("fold != 1").select("a", "b", "same", "alone", "kind", "total")
    design, drop = _kernel_design(train)
    t = design.transform(train.drop(*drop))
    t = fourier_features(t, "scaled", "rff", len(t.first().scaled), 0.05, 12).cache()
    for j in (0, 2, 4):  # machines of fold 1 come first
        fit = LinearSVC(regParam=0.01, maxIter=25, featuresCol="rff", labelCol="y").fit(t.withColumn("y", (F.col("total") == classes[j]).cast("double")))
        assert m.machines[j].out == 1 and losses[j] <= 1.005 * fit.summary().objectiveHistory[-1]
    scored = class_folds(df, 0.05, 0.01, 12, [1, 2, 3, 4]).collect()
    assert sorted(r.account_id for r in scored) == list(range(500)) and {r.prediction for r in scored} <= set(classes)
    assert np.mean([r.prediction == r.total for r in scored]) > 0.4
    _, few = _jobs(spark, lambda: class_folds(df, 0.05, 0.01, 12, [1, 2]).collect(), "class-2")
    _, many = _jobs(spark, lambda: class_folds(df, 0.05, 0.01, 12, [1, 2, 3, 4]).collect(), "class-4")
    assert many < 1.6 * few  # not one fit a fold


def test_huber_folds_equal_separate_fits(spark):
    """Each fold's map is the separate fit's, and its loss that fit's or less."""
    from pyspark.ml.regression import LinearRegression
    from encore.models.fourier import fit_huber_folds, fourier_folds
    from encore.models.kernels import fourier_features
    from encore.models.regressors import _kernel_design
    from encore.search.cv import huber_folds
    df = _fold_rows(spark).cache()
    got, many = _jobs(spark, lambda: {r.account_id: r for r in huber_folds(df, 0.05, 1 / 200, 8, [1, 2, 3, 4]).collect()}, "huber-4")
    assert sorted(got) == list(range(500))
    data = fourier_folds(df, [1, 2, 3, 4], 0.05, 8)
    m, scales, losses = fit_huber_folds(data, 1 / 200)
    plain = {r.account_id: r.design for r in data.vectors(df, ("account_id",)).collect()}
    design, drop = _kernel_design(df.where("fold != 1"))
    t = design.transform(df.drop(*drop))
    t = fourier_features(t, "scaled", "rff", len(t.first().scaled), 0.05, 8).cache()
    fit = LinearRegression(featuresCol="rff", labelCol="total", loss="huber", regParam=1 / 200, maxIter=1000, tol=1e-10).fit(t.where("fold != 1"))
    assert losses[0] == pytest.approx(fit.summary.objectiveHistory[-1], rel=1e-6) and scales[0] == pytest.approx(fit.scale, rel=1e-3)
    for r in fit.transform(t.where("fold = 1")).select("account_id", "rff", "prediction").collect():
        assert data.maps[0].plain(np.array([plain[r.account_id]]))[0] == pytest.approx(r.rff.toArray(), abs=1e-12)
        assert got[r.account_id].prediction == pytest.approx(r.prediction, abs=5e-3)
    _, few = _jobs(spark, lambda: huber_folds(df, 0.05, 1 / 200, 8, [1, 2]).collect(), "huber-2")
    assert many < 1.6 * few


def test_forests_of_all_folds_grow_in_shared_passes(spark):
    from encore.models.boosting import _blocks
    from encore.models.forest import bag, fit_forests, prepared
    from encore.models.boosting import Spec
    from encore.search.cv import forest_folds
    df = _fold_rows(spark).cache()
    counts = bag(np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 20000), 7, 3)
    assert counts.mean() == pytest.approx(1.0, abs=0.03) and counts.var() == pytest.approx(1.0, abs=0.05)
    m = fit_forests(df, [1, 2], trees=6, depth=3)
    _, cur = prepared(df, m.base.specs, "total", "account_id", "fold", ("account_id", "total", "fold"), 32)
    seen = [r for b in cur.toArrow().to_batches() for r in _blocks(b, 2)]
    for model, t in ((0, 0), (1, 4)):  # every node's mean is that of the bag's rows that reach it, and its split the best of what it looks at
        x = np.concatenate([np.concatenate([r.x, r.z[model]]) for r in seen], axis=1)
        y, fold, w = (np.concatenate([v(r) for r in seen]) for v in (lambda r: r.y, lambda r: r.fold, lambda r: bag(r.h, 551724, t)))
        w = np.where(fold == model + 1, 0, w).astype(float)
        reach = {0: w > 0}
        for i in range(15):
            if i not in reach:
                continue
            here = reach[i]
            assert m.value[model, t, i] == pytest.approx((w[here] @ y[here]) / w[here].sum())
            f = m.feature[model, t, i]
            if f >= 0:
                left = np.array([bool(int(m.mask[model, t, i]) >> int(b) & 1) for b in x[f]])
                sse = lambda g: w[g] @ (y[g] - np.average(y[g], weights=w[g])) ** 2
                assert sse(here & left) + sse(here & ~left) < sse(here)
                reach[2 * i + 1], reach[2 * i + 2] = here & left, here & ~left
                if f < 4:  # numbers: no cut of the feature is better
                    cuts = [(here & (x[f] <= c), here & (x[f] > c)) for c in np.unique(x[f][here])[:-1]]
                    assert sse(here & left) + sse(here & ~left) == pytest.approx(min(sse(a) + sse(b) for a, b in cuts))
    got, many = _jobs(spark, lambda: forest_folds(df, 20, 5, "", [1, 2, 3, 4]).collect(), "forest-4")
    assert sorted(r.account_id for r in got) == list(range(500))
    error = np.mean([(r.prediction - r.total) ** 2 for r in got])
    assert error < 0.7 * np.var([r.total for r in got])
    _, few = _jobs(spark, lambda: forest_folds(df, 20, 5, "", [1, 2]).collect(), "forest-2")
    assert many < 1.6 * few


def test_lda_query_gives_contingency_cells(spark):
    from encore.plans.registry import queries
    from .conftest import SF_SMALL

    rows = queries()["lda_fold_errors"](spark, SF_SMALL).collect()
    folds = {r.fold for r in rows}
    assert len(rows) > len(folds) == len({(r.fold, r.error, r.n) for r in rows})
    for f in folds:
        cells = [r for r in rows if r.fold == f]
        assert len({(r.predicted, r.correct) for r in cells}) == len(cells) and sum(r.cell for r in cells) == cells[0].n
        assert cells[0].error == pytest.approx(sum(r.cell for r in cells if r.predicted != r.correct) / cells[0].n, abs=1e-6)


def test_importances_query_grows_all_trees_of_the_driver(spark, monkeypatch):
    from encore.models import boosting as B
    from encore.plans import q_models as Q

    specs = []

    def fit(train, s, *a, **k):
        specs.extend(s)
        return B.Boosted(list(s), ["a"], [], [], None, np.zeros((0, 1)), [0.0], [B.Trees()], [{"a": 1.0}])

    monkeypatch.setattr(Q, "fit_boosted", fit)
    monkeypatch.setattr(Q, "_training", lambda s, d: spark.createDataFrame([(1, 1.0, 1, 1.0, 2.0)], f"account_id long, total double, fold int, `{Q.LAST}` double, a double"))
    assert Q.gbt_importances(spark, "").collect()[0].rel_inf == 100.0
    d = K.GBM_DEFAULTS
    assert [(s.trees, s.shrinkage, s.bagfrac, s.splits, s.minobsinnode, s.loss, s.df, s.out) for s in specs] == [(3375, 0.001, d["bagfrac"], d["depth"], d["minobsinnode"], "tdist", 8.0, -1)]


@pytest.mark.parametrize("loss", ["gaussian", "laplace", "tdist"])
def test_trees_of_one_model_grow_alike_in_one_task(spark, monkeypatch, loss):
    from encore.models import boosting as B

    x, lev, y, rows, schema = _planted()
    df = spark.createDataFrame(rows, schema)
    for spec in (B.Spec(5, 0.3, 1.0, 4, 5, loss, 8.0), B.Spec(6, 0.3, 0.5, 5, 5, loss, 8.0, 1)):
        got = []
        for alone in (B.ALONE, 0):  # in one task; a job a level
            monkeypatch.setattr(B, "ALONE", alone)
            m = B.fit_boosted(df.repartition(3), [spec])
            got.append((m, [r.prediction for r in m.predict(df).orderBy("account_id").collect()]))
            monkeypatch.undo()
        (a, pa_), (b, pb) = got
        assert len(a.trees[0].roots) == spec.trees and np.array_equal(a.trees[0].roots, b.trees[0].roots)
        assert np.allclose(pa_, pb) and dict(a.influence()) == pytest.approx(dict(b.influence()))
        if spec.bagfrac == 1.0:
            assert np.allclose(pa_, _boost_by_hand(x, lev, y, np.arange(len(y)), spec), atol=2e-3)


def test_forest_ways_are_walked_once():
    from encore.models.forest import ways

    feature, mask = np.full((3, 7), -1), np.zeros((3, 7), np.uint64)
    feature[:, 0], mask[:, 0], feature[:, 1], mask[:, 1] = [4, 4, 5], 7, 2, [1, 3, 1]
    root = ways({0: np.array([0, 1]), 1: np.array([1, 2]), 2: np.array([3])}, feature, mask, 2)
    assert set(root.splits) == {(4, 7), (5, 7)} and set(root.splits[4, 7][0].splits) == {(2, 1), (2, 3)}  # the first split of models 0 and 1 is one
    assert sorted((n.draw, n.open) for n in root.leaves()) == [(0, [(0, 0)]), (1, [(0, 1)]), (1, [(1, 0)]), (2, [(1, 1)]), (3, [(2, 0)])]
    feature[1, 0], mask[:, 1] = 4, 1
    assert sorted(n.open for n in ways({m: np.array([1]) for m in (0, 1)}, feature, mask, 2).leaves()) == [[(0, 0), (1, 0)]]


@pytest.mark.parametrize("levels,labels", [(9, "whole"), (9, "any"), (90, "whole")])  # one numbering, sums apart, a numbering for each model
def test_forest_nodes_hold_the_rows_that_reach_them(spark, levels, labels):
    from encore.models.boosting import _blocks
    from encore.models.forest import bag, fit_forests, prepared

    rng = np.random.default_rng(12)
    n = 1500
    a, lev, f = rng.integers(0, 8, n), rng.integers(0, levels, n), rng.integers(1, 4, n)
    lev[0], f[0] = levels, 2  # a level of one fold alone
    y = (a > 3) + (lev % 3) + rng.integers(0, 2, n) * 0.5 + (rng.normal(size=n) if labels == "any" else 0.0)
    df = spark.createDataFrame([(i, float(y[i]), int(f[i]), float(a[i]), f"l{lev[i]}") for i in range(n)], "account_id long, total double, fold int, a double, c string").repartition(3)
    m = fit_forests(df, [1, 2, -1], trees=5, depth=4)
    _, cur = prepared(df, m.base.specs, "total", "account_id", "fold", ("account_id", "total", "fold"), 32)
    seen = [r for b in cur.toArrow().to_batches() for r in _blocks(b, 3)]
    y, fold, h = (np.concatenate([getattr(r, k) for r in seen]) for k in ("y", "fold", "h"))
    splits = 0
    for model, out in enumerate((1, 2, -1)):
        x = np.concatenate([np.concatenate([r.x, r.z[model]]) for r in seen], axis=1)
        for t in range(5):
            w = np.where(fold == out, 0, bag(h, 551724, t)).astype(float)
            reach = {0: w > 0}
            for i in range(15):
                if i in reach and m.feature[model, t, i] >= 0:
                    go = ((m.mask[model, t, i] >> x[m.feature[model, t, i]].astype(np.uint64)) & np.uint64(1)).astype(bool)
                    reach[2 * i + 1], reach[2 * i + 2] = reach[i] & go, reach[i] & ~go
                    splits += 1
            for i, here in reach.items():
                assert m.value[model, t, i] == pytest.approx((w[here] @ y[here]) / w[here].sum())
    assert splits > 60


def test_knn_leaves_out_far_tiles_and_blocks(spark):
    from encore.models import knn

    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(size=(2048, 6)) + 1000.0 * c for c in range(5)])
    x[:, 1:] += rng.normal(size=(len(x), 5)) * 0.1
    y, g = rng.integers(0, 3, len(x)).astype(float), rng.integers(0, 3, len(x))
    perm = rng.permutation(len(x))
    tiles = knn.Tiles(x[perm], y[perm], g[perm])
    for t, (lo, hi) in enumerate(zip([p.start for p in tiles.parts], [p.stop for p in tiles.parts])):
        if np.linalg.norm(tiles.x[lo:hi].mean(axis=0) - x[:2048].mean(axis=0)) > 500:
            tiles.right[t] = np.full_like(tiles.right[t], np.nan)  # never read by queries of the first cluster
    got, labels = tiles.nearest(x[:300], 3, g[:300])
    for i in range(300):
        want = sorted(zip(((x[i] - x) ** 2).sum(1)[g != g[i]], y[g != g[i]]))[:3]
        assert np.allclose(got[i], [w[0] for w in want]) and labels[i].tolist() == [w[1] for w in want]
    # in blocks: cuts through the clusters, a far query, a leaf of equal vectors that is several blocks
    x = np.concatenate([x[::8], np.tile(x[:1], (400, 1))])
    y, g = rng.integers(0, 400, len(x)).astype(float), rng.integers(0, 4, len(x))
    df = spark.createDataFrame([(i, float(y[i]), int(g[i]), x[i].tolist()) for i in range(len(x))], "account_id long, total double, fold int, vec array<double>")
    q = df.select(F.col("account_id").alias("query_id"), "fold", "vec").union(spark.createDataFrame([(-1, 9, [1e5] * 6)], "a long, b int, c array<double>"))
    votes = {r.query_id: r.prediction for r in knn_vote(df, q, vec="vec", apart="fold", block_rows=100).collect()}
    assert len(votes) == len(x) + 1
    for i in [-1, *range(0, len(x), 19)]:
        at, own = (np.full(6, 1e5), 9) if i < 0 else (x[i], g[i])
        near = sorted(zip(((at - x) ** 2).sum(1)[g != own], y[g != own]))[:3]
        got = [v for _, v in near]
        assert votes[i] == min(set(got), key=lambda v: (-got.count(v), v))


def test_huber_steps_begin_at_a_part_and_end_on_all_rows(spark, monkeypatch):
    from encore.models import fourier as Fu

    p = np.random.default_rng(2).normal(size=(301, 7)) * 1e3
    want = np.cos(p)
    assert np.abs(Fu.cosine(p) - want).max() < 1e-12
    df = _fold_rows(spark).cache()
    df = df.repartition(4).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("account_id", F.col("account_id") * 4 + F.col("i")).drop("i")
    monkeypatch.setattr("encore.models.machines.BLOCK", 50)
    seen, summed = [], Fu.summed
    monkeypatch.setattr(Fu, "summed", lambda rows, sums: seen.append(rows) or summed(rows, sums))
    out = []
    for warm in (10 ** 9, 100):  # never; at a third of the blocks
        monkeypatch.setattr(Fu, "WARM", warm)
        monkeypatch.setattr(Fu, "PART", 3)
        data = Fu.fourier_folds(df, [1, 2], 0.05, 6)
        del seen[:]
        losses = Fu.fit_huber_folds(data, 0.01)[2]
        out.append((losses, sum(r is data.packed for r in seen), len(seen)))
    (a, many, _), (b, few, every) = out
    assert a == pytest.approx(b, rel=1e-8) and few < many and few >= 2 and every > few
