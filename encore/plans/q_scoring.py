"""Registered queries: folds and splits, outlier rules, prediction adjustments,
scores, residuals, the submission round trip.

Predictions for the SQL-checkable queries come from a deterministic model: the
mean of the last three seasons (``avg_3_years`` of the feature table)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import numeric as N
from ..operators import adjust as X
from ..operators import evaluate as E
from ..operators.aggregate import contingency
from ..operators.features import build_features, build_history, keep_matching
from ..operators.split import (assign_folds, clean_outliers, every_nth, holdout_flag, prepare_training, split)
from ..search.cv import history_columns
from ..session import scratch_path
from ..models.knn import knn_vote
from ..sources.bind import read_bundle
from ..sources.csv import read_text_csv
from ..sources.sinks import write_submission
from ..spec import binding_spec, suffix
from .common import rounded
from .feature_sql import FEATURE_INPUTS, all_feature_columns, feature_ctes, feature_names, derived_sql, with_ctes
from .q_baseline import snap_sql
from .registry import query

SPEC = binding_spec()
LAST = f"total_{suffix(SPEC.last_season)}"
PRED = "avg_3_years"


def training(spark: SparkSession, sf_dir: str, method: str = "modulo") -> DataFrame:
    b = read_bundle(spark, sf_dir)
    return assign_folds(prepare_training(b.labels, build_features(b)), method=method)


def history_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the columns that predictions and adjustments read, and the fold; no other family is built."""
    b = read_bundle(spark, sf_dir)
    return assign_folds(prepare_training(b.labels, build_history(b)), method="modulo")


def _dbl_cols() -> set[str]:
    numeric, _ = feature_names(SPEC)
    return set(numeric) | {n for n, _ in derived_sql(SPEC)}


TRAIN_CTE = ("train AS (SELECT l.account_id, l.total, CAST(l.account_id % 10 + 1 AS INTEGER) AS fold, "
             "f.* EXCLUDE (account_id) FROM train_labels l LEFT JOIN features f ON l.account_id = f.account_id)")


def _train_sql(select: str, extra: list[str] | None = None) -> str:
    return with_ctes(SPEC, FEATURE_INPUTS + ["train_labels", "to_score"], feature_ctes(SPEC) + [TRAIN_CTE] + (extra or []),
                     select)


# ------------------------------------------------------------------ folds and splits

@query("kfold_assignment", covers=("T1",),
       sql=lambda: with_ctes(SPEC, ["train_labels"], [],
                             "SELECT account_id, CAST(account_id % 10 + 1 AS INTEGER) AS fold FROM train_labels"))
def kfold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold 1..10 of every labelled account (key-modulo variant, checkable in SQL)."""
    return assign_folds(read_bundle(spark, sf_dir).labels.select("account_id"), method="modulo")


@query("kfold_sizes_hashed", covers=("T1", "Q14"))
def kfold_sizes_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts per fold under the seeded-hash assignment (the library default)."""
    f = assign_folds(read_bundle(spark, sf_dir).labels.select("account_id"), method="hash")
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("training_frame", covers=("J3", "C6", "P12", "T2"),
       sql=lambda: _train_sql("SELECT " + ", ".join(
           ["account_id", "round(total, 6) AS total", "fold"]
           + [f"round({c}, 6) AS {c}" if c in _dbl_cols() else c for c in all_feature_columns(SPEC)[1:]])
           + " FROM train"))
def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels joined with the feature table (gaps filled) and the fold column."""
    return rounded(training(spark, sf_dir))


@query("validation_split_sizes", covers=("T2", "T3"),
       sql=lambda: with_ctes(SPEC, ["train_labels"], [],
                             "SELECT fold, n AS n_validation, CAST(sum(n) OVER () - n AS BIGINT) AS n_training FROM "
                             "(SELECT CAST(account_id % 10 + 1 AS INTEGER) AS fold, count(*) AS n FROM train_labels GROUP BY 1) s "
                             "UNION ALL SELECT -1 AS fold, 0 AS n_validation, count(*) AS n_training FROM train_labels"))
def validation_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training / validation row counts of every fold, and of the no-validation split (fold -1)."""
    f = assign_folds(read_bundle(spark, sf_dir).labels.select("account_id"), method="modulo")
    per = f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_validation"))
    from pyspark.sql import Window
    allw = Window.partitionBy(F.lit(0))  # 10 rows: one per fold
    per = per.select("fold", "n_validation", (F.sum("n_validation").over(allw) - F.col("n_validation")).alias("n_training"))
    tr, va = split(f, -1)
    none = tr.agg(F.lit(-1).alias("fold"), F.lit(0).cast("bigint").alias("n_validation"),
                  F.count(F.lit(1)).alias("n_training"))
    return per.unionByName(none)


@query("systematic_holdout", covers=("T5", "P10"),
       sql=lambda: _train_sql("SELECT account_id, account_num FROM train WHERE CAST(account_num AS BIGINT) % 10 = 0"))
def systematic_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth account by account number."""
    t = training(spark, sf_dir)
    return t.where(every_nth("account_num", 10, 0)).select("account_id", "account_num")


@query("holdout_draws", covers=("T4",))
def holdout_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out size for each of the ten seeds of the linear driver (ratio 0.15)."""
    lab = read_bundle(spark, sf_dir).labels.select("account_id")
    aggs = [F.sum(holdout_flag("account_id", s).cast("int")).alias(f"seed_{s}") for s in K.HOLDOUT_SEEDS]
    return lab.agg(F.count(F.lit(1)).alias("n"), *aggs)


# ------------------------------------------------------------------ row filters

@query("outlier_clean", covers=("F3", "Q13"),
       sql=lambda: _train_sql(f"SELECT account_id, total, {LAST} FROM train WHERE abs(total - {LAST}) <= 2"))
def outlier_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows kept by the outlier rule |label - last season| <= 2."""
    return clean_outliers(training(spark, sf_dir), LAST).select("account_id", "total", LAST)


ACTIVE3 = [f"total_{suffix(s)}" for s in SPEC.last(3)]


@query("outlier_variants", covers=("F4",),
       sql=lambda: _train_sql(f"SELECT account_id, total, {LAST} FROM train WHERE abs(total - {LAST}) <= 1.5 "
                              f"AND ({' + '.join(ACTIVE3)}) <> 0"))
def outlier_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stricter variant: jump at most 1.5 and some activity in the last three seasons."""
    t = training(spark, sf_dir)
    return clean_outliers(t, LAST, max_jump=1.5, require_active=ACTIVE3).select("account_id", "total", LAST)


@query("jump_queries", covers=("F8",),
       sql=lambda: _train_sql(f"SELECT account_id, total, {LAST}, CASE WHEN total - {LAST} < -1 THEN 'drop' ELSE 'up_one' END AS kind "
                              f"FROM train WHERE total - {LAST} < -1 OR total - {LAST} = 1"))
def jump_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose label fell by more than one, or rose by exactly one."""
    t = training(spark, sf_dir)
    d = F.col("total") - F.col(LAST)
    return (t.where((d < -1) | (d == 1))
            .select("account_id", "total", LAST, F.when(d < -1, "drop").otherwise("up_one").alias("kind")))


LOOKUP = 7


@query("account_lookup", covers=("F9",),
       sql=lambda: _train_sql("SELECT account_id, total, " + ", ".join(f"total_{suffix(s)}" for s in SPEC.history_seasons)
                              + f" FROM train WHERE account_id = {LOOKUP}"))
def account_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account's label and subscription history."""
    t = training(spark, sf_dir)
    return t.where(F.col("account_id") == LOOKUP).select(
        "account_id", "total", *[f"total_{suffix(s)}" for s in SPEC.history_seasons])


@query("first_rows", covers=("F10", "T7"),
       sql=lambda: with_ctes(SPEC, ["train_labels"], [],
                             "SELECT account_id, total FROM train_labels ORDER BY account_id LIMIT 10"))
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """head(): the first ten labelled accounts in key order."""
    return read_bundle(spark, sf_dir).labels.orderBy("account_id").limit(10)


@query("feature_table_shape", covers=("A20",),
       sql=lambda: _train_sql(f"SELECT count(*) AS n_rows, CAST({len(all_feature_columns(SPEC))} AS INTEGER) AS n_cols "
                              "FROM features"))
def feature_table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim(): rows and columns of the feature table."""
    f = build_features(read_bundle(spark, sf_dir))
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(f.columns)).alias("n_cols"))


# ------------------------------------------------------------------ adjustments

def _adjust_sql_exprs(p: str) -> dict[str, str]:
    last6 = [f"total_{suffix(s)}" for s in SPEC.last(K.ACTIVE_SEASONS)]
    last9 = [f"total_{suffix(s)}" for s in SPEC.last(SPEC.invariant_seasons)]
    inactive = f"({p} * CAST(({' + '.join(last6)}) > 0 AS DOUBLE))"
    const = f"(least({', '.join(last9)}) = greatest({', '.join(last9)}))"
    d = "coalesce(dSF, 0)"
    return {
        "raw": p,
        "inactive": inactive,
        "invariant": f"(CASE WHEN {const} THEN {LAST} ELSE {inactive} END)",
        "round": f"(round_even({p} * 2, 0) / 2)",
        "state": f"({p} * CAST(coalesce(State = 'CA', false) AS DOUBLE))",
        "distance": (f"(CASE WHEN {p} IS NULL THEN NULL ELSE least({p}, CASE WHEN {d} <= 300 THEN CAST(10000 AS DOUBLE) "
                     f"ELSE CAST(0 AS DOUBLE) END, CASE WHEN {d} <= 60 THEN CAST(10000 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) END)"),
    }


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(account_id, prediction) and the history columns that the adjustments read, for every account to score."""
    b = read_bundle(spark, sf_dir)
    hist = build_history(b).select("account_id", F.col(PRED).alias("prediction"), *history_columns(SPEC))
    return b.to_score.join(hist, "account_id", "left")


@query("adjusted_predictions", covers=("X1", "X2", "X3", "X4", "X5", "X6", "J13", "J4", "Q4"),
       sql=lambda: _train_sql("SELECT s.account_id, " + ", ".join(
           f"round({e}, 6) AS {k}" for k, e in _adjust_sql_exprs("f." + PRED).items())
           + f", round({snap_sql('f.' + PRED)}, 6) AS snapped FROM to_score s LEFT JOIN features f ON s.account_id = f.account_id"))
def adjusted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-season-mean predictions for every account to score, under each adjustment rule, and snapped."""
    h = predictions(spark, sf_dir)
    p = F.col("prediction")
    cols = [e.alias(k) for k, e in X.all_adjustments(p, SPEC).items()]
    return rounded(h.select("account_id", *cols, N.snap(p).alias("snapped")))


def _scores_sql() -> str:
    ex = _adjust_sql_exprs(PRED)
    long = " UNION ALL ".join(f"SELECT fold, '{k}' AS adjustment, {e} AS prediction, total FROM train" for k, e in ex.items())
    s = snap_sql("prediction")
    per = (f"per AS (SELECT adjustment, fold, sqrt(avg((ln(1 + {s}) - ln(1 + total)) * (ln(1 + {s}) - ln(1 + total)))) AS r "
           f"FROM ({long}) x GROUP BY adjustment, fold)")
    return _train_sql("SELECT adjustment, round(avg(r), 6) AS mean_rmsle, round(sum(r), 6) AS sum_rmsle, count(*) AS folds "
                      "FROM per GROUP BY adjustment", [per])


def scores_long(t: DataFrame) -> DataFrame:
    adj = X.all_adjustments(F.col(PRED), SPEC)
    wide = t.select("fold", "total", *[e.alias(k) for k, e in adj.items()])
    return wide.unpivot(["fold", "total"], list(adj), "adjustment", "prediction")


@query("adjustment_fold_scores", covers=("E4", "E1", "E5", "X1"), sql=_scores_sql)
def adjustment_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per adjustment: mean and sum over the ten folds of the fold RMSLE (side by side, one pass)."""
    return rounded(E.fold_scores(scores_long(history_training(spark, sf_dir))))


@query("train_vs_validation_scores", covers=("E11",),
       sql=lambda: _train_sql(
           "SELECT CASE WHEN fold = 1 THEN 'validation' ELSE 'training' END AS part, "
           f"round(sqrt(avg((ln(1 + {snap_sql(PRED)}) - ln(1 + total)) * (ln(1 + {snap_sql(PRED)}) - ln(1 + total)))), 6) AS rmsle, "
           "count(*) AS n FROM train GROUP BY 1"))
def train_vs_validation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score on the training folds next to the score on validation fold 1."""
    t = history_training(spark, sf_dir)
    tr, va = split(t, 1)
    a = E.rmsle(tr.withColumn("part", F.lit("training")), PRED, by=["part"])
    b = E.rmsle(va.withColumn("part", F.lit("validation")), PRED, by=["part"])
    return rounded(a.unionByName(b))


@query("log_scale_rmse", covers=("E2", "C18", "Q12"),
       sql=lambda: _train_sql(
           f"SELECT round(sqrt(avg(({snap_sql('ln(1 + ' + PRED + ')')} - ln(1 + total)) * ({snap_sql('ln(1 + ' + PRED + ')')} - ln(1 + total)))), 6) AS rmse_log, "
           f"round(max(abs(exp(ln(1 + {PRED})) - 1 - {PRED})), 6) AS roundtrip_error FROM train"))
def log_scale_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and prediction on the log(1 + x) scale: RMSE of snapped log predictions; expm1 inverts log1p."""
    t = history_training(spark, sf_dir).select(N.log_label("total").alias("total"), N.log_label(PRED).alias("p"), PRED)
    e = E.squared_log_error(F.col("p"), F.col("total"), log_scale=True)
    back = F.abs(N.unlog_label(N.log_label(PRED)) - F.col(PRED))
    return rounded(t.agg(F.sqrt(F.avg(e)).alias("rmse_log"), F.max(back).alias("roundtrip_error")))


CLASS_PRED = f"round_even({PRED}, 0)"


@query("misclassification_rate", covers=("E3",),
       sql=lambda: _train_sql(f"SELECT round(1 - avg(CAST({CLASS_PRED} = total AS DOUBLE)), 6) AS error, count(*) AS n FROM train"))
def misclassification_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of accounts whose rounded prediction is not the label."""
    t = history_training(spark, sf_dir).select(N.round_half_even(PRED).alias("prediction"), "total")
    return rounded(E.misclassification(t))


@query("contingency_table", covers=("A19",),
       sql=lambda: _train_sql(f"SELECT {CLASS_PRED} AS predicted, total AS correct, count(*) AS n FROM train GROUP BY 1, 2"))
def contingency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted x correct counts (long form)."""
    t = history_training(spark, sf_dir).select(N.round_half_even(PRED).alias("predicted"), F.col("total").alias("correct"))
    return contingency(t, "predicted", "correct")


@query("residual_table", covers=("M13", "C19"),
       sql=lambda: _train_sql(f"SELECT account_id, total AS correct, round({snap_sql(PRED)}, 6) AS answer, "
                              f"round(total - {snap_sql(PRED)}, 6) AS residual FROM train"))
def residual_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correct value, snapped answer and residual per account."""
    return rounded(E.residuals(history_training(spark, sf_dir).withColumnRenamed(PRED, "prediction")))


def _drill_cols() -> list[str]:
    import re
    return [c for c in all_feature_columns(SPEC) if re.search("total_201|account_num", c)]


@query("big_error_drilldown", covers=("F7", "P8"),
       sql=lambda: _train_sql("SELECT account_id, total, round(" + snap_sql(PRED) + ", 6) AS answer, "
                              + ", ".join(f"round({c}, 6) AS {c}" for c in _drill_cols())
                              + f" FROM train WHERE fold = 1 AND abs({snap_sql(PRED)} - total) >= 1"))
def big_error_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows of fold 1 with an error of at least one, with recent history columns."""
    t = training(spark, sf_dir)
    _, va = split(t, 1)
    a = N.snap(PRED)
    big = va.where(F.abs(a - F.col("total")) >= 1).withColumn("answer", a)
    return rounded(keep_matching(big, "total_201|account_num", keep=("account_id", "total", "answer")))


# ------------------------------------------------------------------ sink and re-read

def _resub_sql() -> str:
    base = f"({snap_sql(PRED)})"
    last4 = [f"total_{suffix(s)}" for s in SPEC.last(K.ACTIVE_SEASONS_LIGHT)]
    last5 = [f"total_{suffix(s)}" for s in SPEC.last(K.INVARIANT_SEASONS_HARD)]
    light = f"({base} * CAST(({' + '.join(last4)}) > 0 AS DOUBLE))"
    hard = f"(CASE WHEN least({', '.join(last5)}) = greatest({', '.join(last5)}) THEN {LAST} ELSE {light} END)"
    return _train_sql(f"SELECT s.account_id, round({hard}, 6) AS total FROM to_score s LEFT JOIN features f "
                      "ON s.account_id = f.account_id")


@query("resubmission_roundtrip", covers=("S5", "S7", "S2", "S9", "X7", "X8", "C9"), sql=_resub_sql)
def resubmission_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a snapped submission, read it back as text, re-adjust it (light then hard variant)."""
    preds = predictions(spark, sf_dir)
    path = write_submission(preds.select("account_id", "prediction"), scratch_path(spark, f"submissions/{uuid.uuid4().hex}"), "three_season_mean_")
    back = read_text_csv(spark, path, ["account_id", "total"])
    back = back.select(F.col("account_id").cast("bigint").alias("account_id"),
                       N.to_number("total").alias("prediction"))
    h = X.with_history(back, preds.drop("prediction"), SPEC)
    return rounded(h.select("account_id", X.light_and_hard(F.col("prediction"), SPEC).alias("total")))


# ------------------------------------------------------------------ exact KNN (checkable form)

KNN_COLS = [f"total_{suffix(s)}" for s in SPEC.last(3)]


def _knn_sql() -> str:
    d2 = " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in KNN_COLS)
    return _train_sql(
        "SELECT qid AS account_id, label AS prediction FROM best WHERE b = 1",
        [f"pairs AS (SELECT q.account_id AS qid, t.total AS label, {d2} AS d2 FROM train q JOIN train t "
         "ON q.fold <> t.fold)",
         "near AS (SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY d2, label) AS rn FROM pairs)",
         "votes AS (SELECT qid, label, count(*) AS v FROM near WHERE rn <= 3 GROUP BY qid, label)",
         "best AS (SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY v DESC, label) AS b FROM votes)"])


@query("knn_cv_predictions", covers=("M5", "T1", "T2"), sql=_knn_sql)
def knn_cv_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-nearest-neighbour vote for every account from the accounts of the other folds
    (last three seasons' totals as features; ties: nearer, then lower label)."""
    t = history_training(spark, sf_dir).select("account_id", "total", "fold", F.array(*KNN_COLS).alias("vec"))
    q = t.select(F.col("account_id").alias("query_id"), "fold", "vec")
    return knn_vote(t, q, k=K.KNN_K, vec="vec", apart="fold").select(F.col("query_id").alias("account_id"), "prediction")
