"""Registered queries: carry-forward baseline, snapping and RMSLE (the minimum slice)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import evaluate as E
from ..operators.repair import type_subscriptions
from ..operators.reshape import cast_wide
from ..sources.bind import read_bundle
from ..spec import binding_spec, suffix
from .bind_sql import ctes
from .common import rounded
from .feature_sql import prog_cte, subs_cte, subs_t_cte, with_ctes
from .registry import query

SPEC = binding_spec()
LAST = f"total_{suffix(SPEC.last_season)}"


def last_totals(b) -> DataFrame:
    """(account_id, last season's total): a one-cell cast of the subscriptions under the duplicate rule."""
    subs = type_subscriptions(b.subscriptions).where(F.col("season") != SPEC.target_season)
    return cast_wide(subs, "account_id", [(LAST, {"season": SPEC.last_season}, "total")],
                     keys_for_check=["account_id", "season"])


def carry_forward(spark: SparkSession, sf_dir: str, missing_value: float) -> DataFrame:
    """Prediction = last season's subscriptions; accounts without history -> ``missing_value``."""
    b = read_bundle(spark, sf_dir)
    j = b.labels.join(last_totals(b), "account_id", "left")
    return j.select("account_id", F.col("total"),
                    F.coalesce(F.col(LAST), F.lit(missing_value)).alias("prediction"))


def _cf_sql(select: str) -> str:
    return with_ctes(SPEC, ["subscriptions", "programme", "train_labels"],
                     [prog_cte(SPEC), subs_t_cte(SPEC), subs_cte(SPEC),
                      f"""cf AS (SELECT l.account_id, l.total, s.{LAST} AS last_total
                              FROM train_labels l LEFT JOIN subs_f s ON l.account_id = s.account_id)"""],
                     select)


SNAP_SQL = ("(CASE WHEN {x} < 0.03 THEN 0.0 WHEN abs(round_even({x} * 2, 0) / 2 - {x}) < 0.03 "
            "THEN round_even({x} * 2, 0) / 2 ELSE {x} END)")


def snap_sql(x: str) -> str:
    return SNAP_SQL.format(x=x)


@query("carry_forward_predictions", covers=("M11", "C7", "X1"),
       sql=lambda: _cf_sql(f"SELECT account_id, total, {snap_sql('coalesce(last_total, 1.0)')} AS prediction FROM cf"))
def carry_forward_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carry-forward baseline per account (missing history -> 1), snapped."""
    cf = carry_forward(spark, sf_dir, 1.0)
    return cf.select("account_id", "total", N.snap("prediction").alias("prediction"))


def _rmsle_sql(x: str, y: str) -> str:
    s = snap_sql(x)
    return f"sqrt(avg((ln(1 + {s}) - ln(1 + {y})) * (ln(1 + {s}) - ln(1 + {y}))))"


@query("carry_forward_rmsle", covers=("E1", "M11", "C7", "X1", "Q4"),
       sql=lambda: _cf_sql(
           f"SELECT round({_rmsle_sql('coalesce(last_total, 1.0)', 'total')}, 6) AS rmsle_missing_one, "
           f"round({_rmsle_sql('coalesce(last_total, 0.0)', 'total')}, 6) AS rmsle_missing_zero, "
           f"count(*) AS n FROM cf"))
def carry_forward_rmsle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSLE of the carry-forward baseline with missing history -> 1 and -> 0."""
    b = read_bundle(spark, sf_dir)
    j = b.labels.join(last_totals(b), "account_id", "left")
    e1 = E.squared_log_error(F.coalesce(F.col(LAST), F.lit(1.0)), F.col("total"))
    e0 = E.squared_log_error(F.coalesce(F.col(LAST), F.lit(0.0)), F.col("total"))
    return rounded(j.agg(F.sqrt(F.avg(e1)).alias("rmsle_missing_one"),
                         F.sqrt(F.avg(e0)).alias("rmsle_missing_zero"),
                         F.count(F.lit(1)).alias("n")))
