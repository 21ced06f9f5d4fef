"""Scores: RMSLE on snapped predictions, RMSE on the log scale, misclassification,
per-fold summaries. All are single aggregations; only a few numbers reach the driver."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N


def squared_log_error(pred: Column, label: Column, log_scale: bool = False) -> Column:
    a = N.snap(pred)
    if log_scale:
        return (a - label) * (a - label)
    d = F.log1p(a) - F.log1p(label)
    return d * d


def rmsle(df: DataFrame, pred: str = "prediction", label: str = "total", log_scale: bool = False,
          by: Sequence[str] = ()) -> DataFrame:
    """sqrt(mean((log(1 + snap(p)) - log(1 + y))^2)) (or plain RMSE when ``log_scale``)."""
    e = squared_log_error(F.col(pred), F.col(label), log_scale)
    return df.groupBy(*by).agg(F.sqrt(F.avg(e)).alias("rmsle"), F.count(F.lit(1)).alias("n"))


def misclassification(df: DataFrame, pred: str = "prediction", label: str = "total",
                      by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg((1 - F.avg((F.col(pred) == F.col(label)).cast("double"))).alias("error"),
                               F.count(F.lit(1)).alias("n"))


def fold_scores(long: DataFrame, fold: str = "fold", adjustment: str = "adjustment",
                pred: str = "prediction", label: str = "total", log_scale: bool = False) -> DataFrame:
    """Per (adjustment, fold) RMSLE, then mean and sum over folds per adjustment."""
    per = rmsle(long, pred, label, log_scale, by=[adjustment, fold])
    return per.groupBy(adjustment).agg(F.avg("rmsle").alias("mean_rmsle"), F.sum("rmsle").alias("sum_rmsle"),
                                       F.count(F.lit(1)).alias("folds"))


def residuals(df: DataFrame, pred: str = "prediction", label: str = "total") -> DataFrame:
    a = N.snap(F.col(pred))
    return df.select("account_id", F.col(label).alias("correct"), a.alias("answer"),
                     (F.col(label) - a).alias("residual"))
