"""Table-level cell repair and typing of the raw text inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T


def repair_tickets(tickets: DataFrame) -> DataFrame:
    """Blank seats -> 1, blank set -> 0, blank or over-long price level -> 1; then numbers."""
    return tickets.select(
        "account_id", "season",
        T.blank_to("set", "0").alias("set"),
        N.to_number(T.overlong_to(T.blank_to("price_level", "1"), 1, "1")).alias("price_level"),
        N.to_number(T.blank_to("no_seats", "1")).alias("no_seats"),
    )


def type_subscriptions(subs: DataFrame, numeric=("price_level", "no_seats", "total"),
                       factors=("package", "location", "section", "multiple_subs")) -> DataFrame:
    """Numeric variables parsed (bad text -> null), categorical ones normalised."""
    return subs.select(
        "account_id", "season",
        *[N.to_number(c).alias(c) for c in numeric],
        *[T.normalize(c).alias(c) for c in factors],
    )


def profile_lengths(df: DataFrame, col: str) -> DataFrame:
    """Frequency of text lengths of one column (null length counted as its own group)."""
    return df.groupBy(F.length(col).alias("len")).agg(F.count(F.lit(1)).alias("n"))
