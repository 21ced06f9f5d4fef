"""Aggregations: programme composition, composer preferences, frequency tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions.rowwise import poisoned_sum
from ..spec import HistorySpec
from .reshape import melt


def programme_by_season(programme: DataFrame, spec: HistorySpec, how: str = "sum") -> DataFrame:
    """Season x composer counts summed (or maxed) over the sets of a season.

    Restricted to the spec's seasons, so the result has at most
    ``len(spec.history_seasons) + 1`` rows: that bound is what allows it to be
    broadcast to the per-account tables.
    """
    seasons = list(spec.history_seasons) + [spec.target_season]
    f = F.sum if how == "sum" else F.max
    return (programme.where(F.col("season").isin(seasons))
            .groupBy("season")
            .agg(*[f(N.to_number(c)).alias(c) for c in spec.composers]))


def composer_preferences(subs_typed: DataFrame, prog: DataFrame, spec: HistorySpec,
                         composers: Sequence[str] | None = None, prefix: str = "conc_",
                         weight_by_total: bool = True) -> DataFrame:
    """Per account: sum over its seasons of (programme count x subscriptions that season).

    A season of the account that has no programme row makes the sum null (R's
    ``sum`` without ``na.rm``).
    """
    composers = list(composers or spec.preference_composers)
    s = subs_typed.where(F.col("season") != spec.target_season).select("account_id", "season", "total")
    j = s.join(F.broadcast(prog), "season", "left")
    w = (lambda c: F.col(c) * F.col("total")) if weight_by_total else (lambda c: F.col(c))
    return j.groupBy("account_id").agg(*[poisoned_sum(w(c)).alias(prefix + c) for c in composers])


def attendance_long(attended: DataFrame, spec: HistorySpec) -> DataFrame:
    """Wide attendance (one column per season) -> (account_id, season, attended)."""
    return melt(attended, ["account_id"], list(spec.ticket_seasons), "season", "attended")


def missed_preferences(attended: DataFrame, prog: DataFrame, spec: HistorySpec,
                       composers: Sequence[str] | None = None, prefix: str = "conc_missed_") -> DataFrame:
    """Per account: sum over the seasons it did not attend of the programme counts."""
    composers = list(composers or spec.missed_composers)
    missed = attendance_long(attended, spec).where(N.to_number("attended") == 0).select("account_id", "season")
    j = missed.join(F.broadcast(prog), "season", "left")
    return j.groupBy("account_id").agg(*[poisoned_sum(F.col(c)).alias(prefix + c) for c in composers])


def zero_total_flag(subs_typed: DataFrame) -> DataFrame:
    return subs_typed.select("account_id", "season", (F.col("total") == 0).cast("double").alias("zero_total"))


def frequency(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """``table(x)``: count per value, null as its own group."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def contingency(df: DataFrame, row: str, col: str, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Predicted x correct counts in long form (by..., row, col, ``name``)."""
    return df.groupBy(*by, row, col).agg(F.count(F.lit(1)).alias(name))
