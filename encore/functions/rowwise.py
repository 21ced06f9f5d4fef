"""Row-wise statistics over a list of columns, and null-aware aggregates."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _expr(cols: Sequence[Column | str], text: Callable[[list[str]], str], column: Callable[[list[Column]], Column]) -> Column:
    """By ``text`` where all columns are given by name (one call, whatever their number), else by ``column``."""
    if all(isinstance(c, str) for c in cols):
        return F.expr(text([f"`{c}`" for c in cols]))
    return column([F.col(c) if isinstance(c, str) else c for c in cols])


def row_sum(cols: Sequence[Column | str]) -> Column:
    return _expr(cols, " + ".join, lambda cs: reduce(lambda a, b: a + b, cs))


def row_mean(cols: Sequence[Column | str]) -> Column:
    n = float(len(cols))
    return _expr(cols, lambda c: f"({' + '.join(c)}) / {n}D", lambda cs: reduce(lambda a, b: a + b, cs) / n)


def row_var(cols: Sequence[Column | str]) -> Column:
    """Sample variance (n - 1) of the row's values."""
    n = float(len(cols))

    def text(c: list[str]) -> str:
        mean = f"({' + '.join(c)}) / {n}D"
        return f"({' + '.join(f'({x} - {mean}) * ({x} - {mean})' for x in c)}) / {n - 1}D"

    def column(cs: list[Column]) -> Column:
        m = reduce(lambda a, b: a + b, cs) / n
        return reduce(lambda a, b: a + b, [(c - m) * (c - m) for c in cs]) / (n - 1)

    return _expr(cols, text, column)


def row_constant(cols: Sequence[Column | str]) -> Column:
    """True when all values of the row are equal (zero variance, decided exactly)."""
    if len(cols) == 1:
        return F.lit(True)
    return _expr(cols, lambda c: f"least({', '.join(c)}) = greatest({', '.join(c)})", lambda cs: F.least(*cs) == F.greatest(*cs))


def row_any(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conds])


def count_positive(cols: Sequence[Column | str]) -> Column:
    return _expr(cols, lambda c: " + ".join(f"CAST({x} > 0 AS DOUBLE)" for x in c),
                 lambda cs: reduce(lambda a, b: a + b, [(c > 0).cast("double") for c in cs]))


def poisoned_sum(x: Column | str) -> Column:
    """Aggregate: sum that is null as soon as one input is null (R ``sum`` without ``na.rm``)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(F.count(x) < F.count(F.lit(1)), F.lit(None).cast("double")).otherwise(F.sum(x).cast("double"))
