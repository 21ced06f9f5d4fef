"""Registered model and search queries (rows-only checks: fits are not SQL).

They run on the whole training frame, ``gbt_importances`` with the driver's trees, the other boosted queries
with explicit, small tree budgets (``TREES``); the library defaults keep the reference's settings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..models.knn import knn_vote
from ..models.lda import fit_lda, fit_lda_folds
from ..models.regressors import Fitted
from ..models.boosting import Spec, fit_boosted
from ..models.gram import fit_linear_folds, fit_linear_holdouts, scaled
from ..models.machines import Kernel, Machine
from ..models.design import split_columns
from ..operators import evaluate as E
from ..operators.aggregate import contingency
from ..operators.features import build_features, drop_matching, matching_columns
from ..operators.split import assign_folds, clean_outliers, holdout_flag, prepare_scoring, prepare_training
from ..search.cv import boosted_folds, class_folds, forest_folds, history_columns, huber_folds, machine_folds, side_by_side
from ..search.random_search import run_search
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.bind import read_bundle
from ..sources.sinks import write_submission
from ..spec import binding_spec, suffix
from .common import rounded
from .registry import query

SPEC = binding_spec()
LAST = f"total_{suffix(SPEC.last_season)}"
TREES = 20
FOLDS = range(1, K.NUM_FOLDS + 1)


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training frame with hash folds, materialised once."""
    ensure_checkpoint_dir(spark)
    b = read_bundle(spark, sf_dir)
    return assign_folds(prepare_training(b.labels, build_features(b))).checkpoint()


@query("linear_holdout_scores", covers=("M1", "M2", "T4", "F3"))
def linear_holdout_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear model over ten seeded 15 % hold-outs (cleaned training rows), all fitted from one pass; RMSLE per seed."""
    train = _training(spark, sf_dir)
    data = drop_matching(train, K.FILTER_LINEAR, protect=("account_id", "total", "fold", LAST)).drop("fold")
    held = [holdout_flag("account_id", s) for s in K.HOLDOUT_SEEDS]
    m = fit_linear_holdouts(data, held, F.abs(F.col("total") - F.col(LAST)) <= K.OUTLIER_MAX_JUMP)
    groups = F.filter(F.array(*[F.when(h, i) for i, h in enumerate(held)]), lambda g: g.isNotNull())
    rows = data.withColumn("group", F.explode(groups))
    scored = m.predict(rows, F.col("group"), ("group", "total")).withColumn("seed", F.array(*[F.lit(s) for s in K.HOLDOUT_SEEDS])[F.col("group")])
    return rounded(E.rmsle(scored, by=["seed"]).select("seed", "rmsle", "n"))


#: Step that gives the trees of a query the driver's whole learning (3,375 trees of 0.001).
STEP = K.GBM_DEFAULTS["trees"] * K.GBM_DEFAULTS["shrinkage"] / TREES


def _boost_spec(loss: str, whole: bool = False) -> Spec:
    """The driver's settings: all its trees and its step if ``whole``, else ``TREES`` trees with steps as much larger (README: what all 3,375 would take)."""
    d = K.GBM_DEFAULTS
    trees, step = (d["trees"], d["shrinkage"]) if whole else (TREES, STEP)
    return Spec(trees, step, d["bagfrac"], d["depth"], d["minobsinnode"], loss, float(d["df"]), seed=K.FOLD_SEED)


def _boost_scores(spark: SparkSession, sf_dir: str, loss: str) -> DataFrame:
    preds, _ = boosted_folds(_training(spark, sf_dir), [_boost_spec(loss)], SPEC, K.FILTER_GBM, FOLDS, clean=True)
    return rounded(E.fold_scores(side_by_side(preds, SPEC)))


@query("gbt_fold_scores", covers=("M4", "M1", "E4", "E5", "F3"))
def gbt_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees (squared loss, depth and bag of the driver) under 10-fold CV with cleaning; every adjustment scored side by side."""
    return _boost_scores(spark, sf_dir, "gaussian")


@query("laplace_boost_fold_scores", covers=("M4", "E5"))
def laplace_boost_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees with absolute loss (leaves are medians) under 10-fold CV; every adjustment scored side by side."""
    return _boost_scores(spark, sf_dir, "laplace")


@query("tdist_boost_fold_scores", covers=("M4t", "E5"))
def tdist_boost_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Student-t loss boosting (df 8; leaves are locations of the t-distribution) under 10-fold CV; every adjustment side by side."""
    return _boost_scores(spark, sf_dir, "tdist")


@query("knn_fold_scores", covers=("M5", "M9", "E5"))
def knn_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-nearest-neighbour vote on scaled features (scaled by all training rows), every account by the accounts of the other folds."""
    rows = _machine_rows(spark, sf_dir, K.FILTER_KNN)
    q = rows.select(F.col("account_id").alias("query_id"), "fold", "total", *history_columns(SPEC), "scaled")
    votes = knn_vote(rows, q, k=K.KNN_K, vec="scaled", apart="fold", keep=("fold", "total", *history_columns(SPEC)))
    return rounded(E.fold_scores(side_by_side(votes, SPEC, ["raw", "inactive", "invariant"])))


@query("forest_fold_scores", covers=("M8", "E5"))
def forest_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean prediction of 300 randomised trees, 10-fold CV."""
    preds = forest_folds(_training(spark, sf_dir), K.FOREST_TREES, 5, K.FILTER_FOREST, FOLDS, KEPT)
    return rounded(E.fold_scores(side_by_side(preds, SPEC, ["raw", "inactive", "invariant"])))


@query("rff_svr_fold_scores", covers=("M6", "M9", "E5"))
def rff_svr_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radial-kernel regression (cost 20, gamma 0.025) via random Fourier features, 10-fold CV."""
    train = _training(spark, sf_dir)
    preds = huber_folds(train, gamma=0.025, reg=1.0 / (20.0 * 10.0), folds=FOLDS, columns=_kept(train, K.FILTER_SVR), keep=KEPT)
    return rounded(E.fold_scores(side_by_side(preds, SPEC, ["raw", "inactive", "invariant"])))


def _kept(train: DataFrame, filt: str) -> list[str]:
    """Columns that the filter leaves."""
    gone = set(matching_columns(train.columns, filt))
    return [c for c in train.columns if c not in gone]


def _machine_rows(spark: SparkSession, sf_dir: str, filt: str) -> DataFrame:
    """(account_id, total, fold, history columns, scaled): the filtered features as scaled design columns."""
    train = _training(spark, sf_dir)
    rows, _ = scaled(train, columns=_kept(train, filt), keep=("account_id", "total", "fold", *history_columns(SPEC)))
    return rows


KEPT = ("account_id", "total", "fold", *history_columns(SPEC))


@query("svr_grid_search", covers=("E6", "M6", "M9"))
def svr_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epsilon-insensitive radial-kernel regression over the cost x gamma grid (3 x 3), ten folds each: ninety machines in the same passes."""
    kernels = [Kernel("radial", g) for g in K.SVR_GRID["gamma"]]
    grid = [(c, g) for g in range(len(kernels)) for c in K.SVR_GRID["cost"]]
    settings = [Machine(g, "regression", float(c), K.SVR_EPSILON) for c, g in grid]
    preds, _ = machine_folds(_machine_rows(spark, sf_dir, K.FILTER_SVR), kernels, settings, FOLDS, keep=KEPT)
    each = preds.select("fold", "total", F.posexplode("scores").alias("i", "prediction"))
    per = E.rmsle(each, by=["i", "fold"]).groupBy("i").agg(F.avg("rmsle").alias("mean_rmsle"))
    name = F.array(*[F.struct(F.lit(float(c)).alias("cost"), F.lit(kernels[g].width).alias("gamma")) for c, g in grid])[F.col("i")]
    return rounded(per.select(name["cost"].alias("cost"), name["gamma"].alias("gamma"), "mean_rmsle"))


@query("bessel_svr_fold_scores", covers=("M6", "E5"))
def bessel_svr_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bessel-kernel regression with the driver's settings (epsilon-insensitive loss, cleaned rows), ten folds; adjustments side by side."""
    d = K.KERNEL_SVR
    rows = _machine_rows(spark, sf_dir, K.FILTER_KERNEL_SVR)
    clean = F.abs(F.col("total") - F.col(LAST)) <= K.OUTLIER_MAX_JUMP
    preds, _ = machine_folds(rows, [Kernel("bessel", d["sigma"], d["order"], d["degree"])], [Machine(0, "regression", d["cost"], d["epsilon"])],
                             FOLDS, learn=clean, keep=KEPT)
    return rounded(E.fold_scores(side_by_side(preds.withColumn("prediction", F.col("scores")[0]), SPEC)))


@query("bessel_svc_fold_errors", covers=("M7", "E3", "P14", "C10"))
def bessel_svc_fold_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bessel-kernel classification of the label as a class with the driver's settings (one machine a class, cleaned rows): errors by fold."""
    d = K.KERNEL_SVC
    rows = _machine_rows(spark, sf_dir, K.FILTER_SVC)
    classes = [r.total for r in rows.select("total").distinct().orderBy("total").collect()]  # whole numbers of subscriptions
    clean = F.abs(F.col("total") - F.col(LAST)) <= K.OUTLIER_MAX_JUMP
    preds, _ = machine_folds(rows, [Kernel("bessel", d["sigma"], d["order"], d["degree"])],
                             [Machine(0, "class", d["cost"], 0.0, positive=float(c)) for c in classes], FOLDS, learn=clean, keep=("account_id", "total", "fold"))
    # the largest score wins; of equal ones the smaller class
    best = F.array_max(F.transform("scores", lambda s, i: F.struct(s.alias("s"), (-i).alias("i"))))["i"]
    named = preds.withColumn("prediction", F.element_at(F.array(*[F.lit(float(c)) for c in classes]), 1 - best))
    return rounded(E.misclassification(named, by=["fold"]).select("fold", "error", "n"))


@query("rff_svc_fold_errors", covers=("M7", "E3", "P14", "C10"))
def rff_svc_fold_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support-vector classification of the label as a class (one-vs-rest on random Fourier features);
    misclassification rate per fold."""
    train = _training(spark, sf_dir)
    clean = F.abs(F.col("total") - F.col(LAST)) <= K.OUTLIER_MAX_JUMP
    preds = class_folds(train, gamma=0.001, reg=1.0 / 100.0, n_components=100, folds=FOLDS, columns=_kept(train, K.FILTER_SVC), learn=clean)
    return rounded(E.misclassification(preds, by=["fold"]).select("fold", "error", "n"))


@query("lda_fold_errors", covers=("M3", "E3"))
def lda_fold_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear discriminant classes per fold: each contingency cell (predicted x correct, with its rows), beside the fold's misclassification rate and rows."""
    train = drop_matching(_training(spark, sf_dir), K.FILTER_KNN)
    train = train.select("account_id", "total", "fold", *split_columns(train)[0])
    p = fit_lda_folds(train).predict(train, F.col("fold"), ("fold", "total")).checkpoint()  # read twice
    cells = contingency(p, "prediction", "total", by=["fold"], name="cell")
    return rounded(E.misclassification(p, by=["fold"]).join(cells, "fold").select("fold", "error", "n", F.col("prediction").alias("predicted"), F.col("total").alias("correct"), "cell"))


def _lda_sql() -> str:
    """Two columns: class means, pooled covariance and its inverse in closed form."""
    return _train3_sql("""SELECT account_id, k AS predicted FROM (
  WITH m AS (SELECT y AS k, count(*) AS n, avg(x0) AS m0, avg(x1) AS m1 FROM t3 GROUP BY y),
  s AS (SELECT sum((x0 - m0) * (x0 - m0)) / (count(*) - (SELECT count(*) FROM m)) + 1e-6 AS a, sum((x0 - m0) * (x1 - m1)) / (count(*) - (SELECT count(*) FROM m)) AS b,
    sum((x1 - m1) * (x1 - m1)) / (count(*) - (SELECT count(*) FROM m)) + 1e-6 AS c, count(*) AS n FROM t3 JOIN m ON t3.y = m.k),
  w AS (SELECT k, (c * m0 - b * m1) / (a * c - b * b) AS w0, (a * m1 - b * m0) / (a * c - b * b) AS w1, ln(m.n / CAST(s.n AS DOUBLE)) AS p, m0, m1 FROM m, s)
  SELECT account_id, k, row_number() OVER (PARTITION BY account_id ORDER BY round(w0 * x0 + w1 * x1 - 0.5 * (w0 * m0 + w1 * m1) + p, 9) DESC, k DESC) AS r FROM t3, w) z WHERE r = 1""")


@query("lda_classes", covers=("M3",), sql=_lda_sql)
def lda_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class that linear discriminant analysis of the label on two history columns gives each account."""
    t = _modulo_training(spark, sf_dir).select("account_id", "total", *LINEAR_COLUMNS[:2])
    return fit_lda(t).predict(t).select("account_id", F.col("prediction").alias("predicted"))


@query("gbt_importances", covers=("M10", "T8"))
def gbt_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative influence (%) of each feature in the driver's boosted-tree fit on all rows (all 3,375 trees of step 0.001), descending."""
    train = drop_matching(_training(spark, sf_dir), K.FILTER_GBM, protect=("account_id", "total", "fold", LAST))
    m = fit_boosted(clean_outliers(train, LAST).drop("fold"), [_boost_spec(K.GBM_DEFAULTS["distrib"], whole=True)])
    df = spark.createDataFrame(m.influence(), "var string, rel_inf double")
    return rounded(df.orderBy(F.col("rel_inf").desc()))


@query("random_search_trials", covers=("E7", "E8", "E9", "E10", "T6", "S10"))
def random_search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two seeded search trials (tree counts scaled by 1/200, step x 50), 10-fold CV with early
    abandon; each trial's row written to the trial table and read from it."""
    return rounded(run_search(_training(spark, sf_dir), SPEC, scratch_path(spark, f"trials/{uuid.uuid4().hex}"), n_trials=2, seed=20141116,
                              folds=FOLDS, tree_budget=1 / 200, step_scale=50.0))


@query("gbt_submission", covers=("S7", "J4"))
def gbt_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refit boosted trees on all cleaned rows, score every account to score, write the submission."""
    ensure_checkpoint_dir(spark)
    b = read_bundle(spark, sf_dir)
    feats = build_features(b).checkpoint()
    train = drop_matching(prepare_training(b.labels, feats), K.FILTER_GBM, protect=("account_id", "total", LAST))
    m = fit_boosted(clean_outliers(train, LAST), [_boost_spec(K.GBM_DEFAULTS["distrib"])])
    p = m.predict(prepare_scoring(b.to_score, feats))
    write_submission(p, scratch_path(spark, f"submissions/{uuid.uuid4().hex}"), "gbt_sub_")
    from ..functions.numeric import snap
    return rounded(p.select("account_id", snap("prediction").alias("total")))


LINEAR_COLUMNS = [f"total_{suffix(s)}" for s in SPEC.last(2)] + [f"add_tickets_total_{suffix(SPEC.last_season)}"]


def _modulo_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_bundle(spark, sf_dir)
    return assign_folds(prepare_training(b.labels, build_features(b)).select("account_id", "total", *LINEAR_COLUMNS), method="modulo")


def _train3_sql(body: str) -> str:
    from .feature_sql import FEATURE_INPUTS, feature_ctes, with_ctes
    x = ", ".join(f"coalesce(f.{c}, 0) AS x{i}" for i, c in enumerate(LINEAR_COLUMNS))
    t = (f"t3 AS (SELECT l.account_id, l.total AS y, (l.account_id % 10) + 1 AS fold, {x} FROM train_labels l "
         "LEFT JOIN features f ON l.account_id = f.account_id)")
    return with_ctes(SPEC, FEATURE_INPUTS + ["train_labels", "to_score"], feature_ctes(SPEC) + [t], body)


def _normal_sql() -> str:
    """Centred normal equations of three columns by Cramer's rule, for the rows outside each fold (-1: all rows)."""
    cov = ", ".join(f"covar_pop(x{i}, x{j}) AS c{i}{j}" for i in range(3) for j in range(i, 3))
    m = lambda i, j: f"c{min(i, j)}{max(i, j)}"

    def det(cols: list[list[str]]) -> str:
        a, b, c = cols
        return (f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]}) "
                f"+ {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))")

    cols, v = [[m(i, j) for i in range(3)] for j in range(3)], ["v0", "v1", "v2"]
    b = [f"{det([v if k == j else cols[k] for k in range(3)])} / {det(cols)} AS b{j}" for j in range(3)]
    rows = " UNION ALL ".join([f"SELECT fold, '{c}' AS term, round(b{i}, 6) AS coefficient FROM s" for i, c in enumerate(LINEAR_COLUMNS)]
                              + ["SELECT fold, 'constant', round(my - b0 * m0 - b1 * m1 - b2 * m2, 6) FROM s"])
    return _train3_sql("SELECT fold, term, coefficient FROM (WITH g AS (SELECT f.fold, " + cov + ", "
                       + ", ".join(f"covar_pop(x{i}, y) AS v{i}, avg(x{i}) AS m{i}" for i in range(3)) + ", avg(y) AS my FROM t3, "
                       "(SELECT CAST(unnest([-1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS INTEGER) AS fold) f WHERE t3.fold <> f.fold GROUP BY f.fold), "
                       f"s AS (SELECT *, {', '.join(b)} FROM g) {rows}) z")


@query("linear_fold_coefficients", covers=("M2", "E5", "M1"), sql=_normal_sql)
def linear_fold_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares of the label on three history columns: the coefficients of each fold's training rows (fold -1: of all rows),
    all from one pass over the rows."""
    m = fit_linear_folds(_modulo_training(spark, sf_dir), columns=LINEAR_COLUMNS, ridge=0.0)
    rows = [(f, t, float(v)) for f, (c, w) in m.solutions.items() for t, v in [*zip(m.by.names, w), ("constant", c)]]
    return rounded(spark.createDataFrame(rows, "fold int, term string, coefficient double"))


@query("scaled_columns", covers=("M9",), sql=lambda: _train3_sql(
    "SELECT account_id, " + ", ".join(f"round((x{i} - (SELECT avg(x{i}) FROM t3 WHERE fold <> 1)) / (SELECT stddev_samp(x{i}) FROM t3 WHERE fold <> 1), 6) AS z{i}"
                                      for i in range(3)) + " FROM t3"))
def scaled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns scaled by the mean and standard deviation of the rows outside fold 1."""
    z, names = scaled(_modulo_training(spark, sf_dir), columns=LINEAR_COLUMNS, keep=("account_id",), fit_on=F.col("fold") != 1)
    return rounded(z.select("account_id", *[F.col("scaled")[names.index(c)].alias(f"z{i}") for i, c in enumerate(LINEAR_COLUMNS)]))


POLY = [f"total_{suffix(s)}" for s in SPEC.last(3)]


def _poly_sql() -> str:
    from .feature_sql import FEATURE_INPUTS, feature_ctes, with_ctes
    a, b, c = (f"ln(1 + {x})" for x in POLY)
    terms = [a, f"{a} * {a}", b, f"{a} * {b}", f"{b} * {b}", c, f"{a} * {c}", f"{b} * {c}", f"{c} * {c}"]
    return with_ctes(SPEC, FEATURE_INPUTS + ["train_labels", "to_score"], feature_ctes(SPEC),
                     "SELECT account_id, " + ", ".join(f"round({t}, 6) AS poly_{i}" for i, t in enumerate(terms))
                     + " FROM features")


@query("log_polynomial_terms", covers=("D11",), sql=_poly_sql)
def log_polynomial_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degree-2 polynomial expansion of log(1 + total) over the last three seasons."""
    from pyspark.ml.functions import vector_to_array
    from ..models.design import log_polynomial
    feats = build_features(read_bundle(spark, sf_dir))
    df, pe = log_polynomial(feats.select("account_id", *POLY), POLY, 2, "poly")
    arr = pe.transform(df).select("account_id", vector_to_array("poly").alias("p"))
    return rounded(arr.select("account_id", *[F.col("p")[i].alias(f"poly_{i}") for i in range(9)]))
