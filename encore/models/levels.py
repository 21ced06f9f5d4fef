"""Factor levels as a numbered table.

The levels of all factors stand in one table (factor, level, number), ordered within a factor by
the mean label of the level's rows, so that a split of a tree on the number is a split of the levels. The table
is computed, numbered and joined as a DataFrame: no list of levels reaches the driver, whatever their number. Where several
models leave out a fold of rows each, a level has one number for each model, from the means of its
own training rows: totals over all rows less those of the fold.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_dense_index


def level_table(train: DataFrame, factors: Sequence[str], label: str, folds: Sequence[int] = (), fold: str = "fold") -> DataFrame:
    """(factor, level, model, number): dense numbers from 0 of each factor's levels by mean label, then level.

    ``folds`` lists the fold that each model leaves out (model i leaves out ``folds[i]``); without folds there is one model, 0, over
    all rows. A level that a model's rows do not hold has no row for it. Null is a level of its own, written as null.
    """
    long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("factor"), F.col(f"`{c}`").cast("string").alias("level")) for c in factors])).alias("x"),
                        F.col(f"`{label}`").cast("double").alias("y"), (F.col(fold) if folds else F.lit(-1)).alias("f"))
    parts = long.groupBy("x.factor", "x.level", "f").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
    models = F.array(*[F.struct(F.lit(i).alias("model"), F.lit(f).alias("out")) for i, f in enumerate(folds or [-2])])
    means = (parts.select("factor", "level", "f", "s", "n", F.explode(models).alias("m")).where(F.col("m.out") != F.col("f"))
             .groupBy("m.model", "factor", "level").agg((F.sum("s") / F.sum("n")).alias("mean")))
    # one key that sorts by model, factor, mean and level
    keyed = means.select("model", "factor", "level", F.struct("model", "factor", "mean", "level").alias("k"))
    placed = with_dense_index(keyed, "k", "at")
    first = placed.groupBy("model", "factor").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(first), ["model", "factor"]).select("factor", "level", "model", (F.col("at") - F.col("first")).alias("number"))


def dictionary(table: DataFrame, models: int = 1) -> DataFrame:
    """(factor, level, numbers): :func:`level_table`'s numbers as one array of all models for each level, -1 where a model has none; written
    to the checkpoint folder, as each factor's join reads it."""
    by = F.map_from_entries(F.collect_list(F.struct("model", "number")))  # one entry a model
    numbers = F.array(*[F.coalesce(F.try_element_at("m", F.lit(i)), F.lit(-1.0)) for i in range(models)])
    return table.groupBy("factor", "level").agg(by.alias("m")).select("factor", "level", numbers.alias("numbers")).checkpoint()


def with_level_numbers(df: DataFrame, levels: DataFrame, factors: Sequence[str], models: int = 1, suffix: str = "__no") -> DataFrame:
    """``df`` with ``<factor><suffix>``: an array of each model's number of the row's level; -1 for levels unseen by the model.

    One left join of :func:`dictionary` for each factor; Spark broadcasts a factor's levels if their size is below its threshold,
    and joins by shuffle (splitting hot levels) otherwise.
    """
    none = F.array(*[F.lit(-1.0)] * models)

    def one(rows: DataFrame, c: str) -> DataFrame:
        d = levels.where(F.col("factor") == c).select(F.col("level").alias("__l"), F.col("numbers").alias("__a"))
        found = rows.join(d, F.col(f"`{c}`").cast("string").eqNullSafe(F.col("__l")), "left")
        return found.select(*[f"`{x}`" for x in rows.columns], F.coalesce("__a", none).alias(c + suffix))

    return reduce(one, factors, df)
