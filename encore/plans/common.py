"""Shared helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (stable value hashes against the SQL oracle)."""
    return df.selectExpr(*[f"round(`{f.name}`, {digits}) AS `{f.name}`" if isinstance(f.dataType, (DoubleType, FloatType)) else f"`{f.name}`"
                           for f in df.schema.fields])


def sql_round(cols_types: list[tuple[str, str]], digits: int = DIGITS) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" if t == "double" else c for c, t in cols_types)
