"""Numeric cell functions, rounding and the prediction snap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text -> double; text that is not a number becomes null (never raises)."""
    return _c(c).try_cast("double")


def flag(cond: Column) -> Column:
    """Boolean -> 0.0/1.0 (null stays null)."""
    return cond.cast("double")


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, 0 when den is 0 (no divide-by-zero error under ANSI)."""
    d = _c(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(_c(num) / d)


def year_of(c: Column | str, blank_year: int) -> Column:
    """First four characters as a year; blank -> ``blank_year``."""
    head = F.substring(_c(c), 1, 4)
    return F.when(head == "", F.lit(str(blank_year))).otherwise(head).try_cast("double")


def round_half_even(x: Column | str) -> Column:
    """Round to the nearest integer, ties to even (``F.round`` rounds ties up)."""
    return F.rint(_c(x))


def round_to_half(x: Column | str) -> Column:
    """Nearest multiple of 0.5, ties to even."""
    return F.rint(_c(x) * 2) / 2


def snap(x: Column | str, threshold: float = K.SNAP_THRESHOLD) -> Column:
    """Below ``threshold`` -> 0; strictly within it of the nearest half -> that half."""
    x = _c(x)
    half = round_to_half(x)
    return (F.when(x < threshold, F.lit(0.0))
            .when(F.abs(half - x) < threshold, half)
            .otherwise(x))


def log_label(x: Column | str) -> Column:
    return F.log1p(_c(x))


def unlog_label(x: Column | str) -> Column:
    return F.expm1(_c(x))
