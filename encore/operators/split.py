"""Deterministic folds, hold-out draws, training splits and outlier cleaning.

Fold membership is a pure function of the key (a seeded hash), so it is stable
under any repartitioning, retry or executor loss: no random draw is replayed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from .. import constants as K
from ..functions import text as T


def fold_of(key: Column | str, k: int = K.NUM_FOLDS, seed: int = K.FOLD_SEED, method: str = "hash") -> Column:
    """Fold number 1..k of a key: seeded xxhash64 (default) or plain key modulo."""
    key = F.col(key) if isinstance(key, str) else key
    if method == "hash":
        return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(k)) + 1).cast("int")
    if method == "modulo":
        return (F.pmod(key, F.lit(k)) + 1).cast("int")
    raise ValueError(method)


def assign_folds(df: DataFrame, key: str = "account_id", k: int = K.NUM_FOLDS, seed: int = K.FOLD_SEED,
                 method: str = "hash", col: str = "fold") -> DataFrame:
    return df.withColumn(col, fold_of(key, k, seed, method))


def holdout_flag(key: Column | str, seed: int, ratio: float = K.HOLDOUT_RATIO) -> Column:
    """True for about ``ratio`` of the keys, drawn independently per seed."""
    key = F.col(key) if isinstance(key, str) else key
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1_000_000.0
    return u < ratio


def every_nth(index_col: str, n: int = 10, offset: int = 0) -> Column:
    """Systematic hold-out: rows whose (1-based) number is offset mod n."""
    return F.pmod(F.col(index_col).cast("long"), F.lit(n)) == offset


def prepare_training(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels left-joined with the feature table; gaps -> 0 (numeric) or the NA level (text)."""
    j = labels.join(features, "account_id", "left")
    def filled(name: str, kind: DataType) -> str:
        if name == "account_id":
            return f"`{name}`"
        if isinstance(kind, StringType):
            return f"{T.NA_LEVEL_SQL.format(c=name)} AS `{name}`"
        return f"coalesce(`{name}`, CAST(0 AS {kind.simpleString()})) AS `{name}`"

    return j.selectExpr(*[filled(f.name, f.dataType) for f in j.schema.fields])


def prepare_scoring(to_score: DataFrame, features: DataFrame) -> DataFrame:
    """Rows to score left-joined with the feature table (``prepareDataToPredict``)."""
    return prepare_training(to_score, features)


def split(df: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) for one fold; fold -1 means no validation rows."""
    if fold < 0:
        return df, df.limit(0)
    return df.where(F.col(fold_col) != fold), df.where(F.col(fold_col) == fold)


def clean_outliers(df: DataFrame, last_total: str, label: str = "total",
                   max_jump: float = K.OUTLIER_MAX_JUMP, require_active: list[str] | None = None) -> DataFrame:
    """Keep rows whose label is within ``max_jump`` of last season's total (training rows only)."""
    cond = F.abs(F.col(label) - F.col(last_total)) <= max_jump
    if require_active:
        s = F.lit(0.0)
        for c in require_active:
            s = s + F.col(c)
        cond = cond & (s != 0)
    return df.where(cond)
