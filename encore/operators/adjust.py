"""Rule-based prediction adjustments.

Predictions are a ``(account_id, prediction)`` frame joined to the history
columns by key (never by position). Each rule is a column expression, so all of
them can be evaluated side by side in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import numeric as N
from ..functions import rowwise as RW
from ..spec import HistorySpec, suffix


def _totals(spec: HistorySpec, n: int) -> list[str]:
    return [f"total_{suffix(s)}" for s in spec.last(n)]


def with_history(preds: DataFrame, history: DataFrame, spec: HistorySpec) -> DataFrame:
    """Predictions left-joined to the columns the rules read."""
    need = ["account_id", *[f"total_{suffix(s)}" for s in spec.history_seasons], "State", "dSF"]
    h = history.select(*[c for c in need if c in history.columns])
    return preds.join(h, "account_id", "left")


def rounded(p: Column) -> Column:
    return N.round_to_half(p)


def inactive_zero(p: Column, spec: HistorySpec, n_seasons: int = K.ACTIVE_SEASONS) -> Column:
    """0 unless the account bought in one of the last ``n_seasons`` seasons."""
    return p * N.flag(RW.row_sum(_totals(spec, n_seasons)) > 0)


def out_of_state_zero(p: Column) -> Column:
    return p * F.coalesce(F.col("State") == K.HOME_STATE, F.lit(False)).cast("double")


def distance_capped(p: Column, dist: str = "dSF") -> Column:
    """Beyond the far cap -> 0, beyond the near cap -> at most 1 (missing distance = 0)."""
    d = F.coalesce(F.col(dist), F.lit(0.0))
    far = F.when(d <= K.FAR_CAP_MILES, F.lit(K.NO_CAP)).otherwise(F.lit(0.0))
    near = F.when(d <= K.NEAR_CAP_MILES, F.lit(K.NO_CAP)).otherwise(F.lit(K.NEAR_CAP_VALUE))
    return F.when(p.isNull(), F.lit(None).cast("double")).otherwise(F.least(p, far, near))


def invariant_last(p: Column, spec: HistorySpec, n_invariant: int | None = None,
                   n_active: int | None = K.ACTIVE_SEASONS) -> Column:
    """Inactive rule first (if ``n_active``); then, when the last ``n_invariant``
    seasons (those of the spec by default) are all equal, last season's total replaces the prediction."""
    q = inactive_zero(p, spec, n_active) if n_active else p
    const = RW.row_constant(_totals(spec, n_invariant or spec.invariant_seasons))
    return F.when(const, F.col(f"total_{suffix(spec.last_season)}")).otherwise(q)


def all_adjustments(p: Column, spec: HistorySpec) -> dict[str, Column]:
    """The five adjustments of the model drivers plus the raw prediction."""
    return {
        "raw": p,
        "inactive": inactive_zero(p, spec),
        "invariant": invariant_last(p, spec),
        "round": rounded(p),
        "state": out_of_state_zero(p),
        "distance": distance_capped(p),
    }


def light_and_hard(p: Column, spec: HistorySpec) -> Column:
    """Re-adjusting an earlier submission: 4-season activity, then 5-season invariance."""
    light = inactive_zero(p, spec, K.ACTIVE_SEASONS_LIGHT)
    return invariant_last(light, spec, K.INVARIANT_SEASONS_HARD, None)
