"""Random search over feature filters and boosted-tree parameters.

Draws are seeded (not clock-seeded) and a fixed number of trials replaces the
endless loop. Each trial is a cross-validation whose folds are fitted together;
the budget rule redraws too costly draws, a bad first fold abandons the trial,
and every trial is a row of a Parquet table from which a search resumes.
"""

from __future__ import annotations

import datetime as _dt
import random
from dataclasses import asdict, dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..models.boosting import Spec
from ..operators import evaluate as E
from ..sources.sinks import stamp
from ..spec import HistorySpec
from .cv import boosted_folds, side_by_side


@dataclass
class Trial:
    filter: str
    trees: int
    bagfrac: float
    shrinkage: float
    depth: int
    distrib: str
    df: float
    n_tokens: int


def budget_exceeded(trees: int, depth: int, n_tokens: int, rules=K.SEARCH_BUDGET) -> bool:
    """True when a draw is too costly (many trees, deep trees, few dropped tokens)."""
    return any(trees > t and depth > d and n_tokens < n for t, d, n in rules)


def draw_trial(rng: random.Random, filter_override: str | None = K.SEARCH_FIXED_FILTER) -> Trial:
    toks = K.SEARCH_TOKENS
    n_tokens = rng.randint(1, len(toks))
    picked = rng.sample(range(len(toks)), n_tokens)
    filt = "|".join([K.SEARCH_START_FILTER, "|".join(toks[i] for i in picked)])
    if filter_override is not None:
        filt = filter_override
    trees = rng.choice(K.SEARCH_TREES)
    shrinkage = rng.choice(K.SEARCH_SHRINKAGE)
    bagfrac = rng.choice(K.SEARCH_BAGFRAC)
    depth = rng.choice(K.SEARCH_DEPTHS)
    distrib = rng.choice(K.SEARCH_DISTRIB)
    df = rng.choice(K.SEARCH_DF)
    while budget_exceeded(trees, depth, n_tokens):
        trees = rng.choice(K.SEARCH_TREES)
        depth = rng.choice(K.SEARCH_DEPTHS)
    return Trial(filt, trees, bagfrac, shrinkage, depth, distrib, float(df), n_tokens)


def draw_trials(n: int, seed: int, filter_override: str | None = K.SEARCH_FIXED_FILTER) -> list[Trial]:
    rng = random.Random(seed)
    return [draw_trial(rng, filter_override) for _ in range(n)]


SCHEMA = ("trial int, filter string, trees long, bagfrac double, shrinkage double, depth long, distrib string, df double, "
          "n_tokens long, trees_run long, step_run double, abandoned boolean, mean_raw double, sum_raw double, "
          "mean_inactive double, mean_invariant double, accept_raw boolean, accept_inactive boolean, "
          "accept_invariant boolean, date string")


def _finished(spark: SparkSession, path: str, n: int) -> bool:
    """Whether a trial's row is in the table (a write that was cut off leaves no _SUCCESS)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part={n}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_search(train_all: DataFrame, spec: HistorySpec, trial_table: str, n_trials: int = 2, seed: int = 1,
               folds=range(1, K.NUM_FOLDS + 1), tree_budget: float = 1.0, step_scale: float = 1.0,
               threshold: float = K.ACCEPT_THRESHOLD, abandon_above: float = K.ABANDON_THRESHOLD,
               filter_override: str | None = K.SEARCH_FIXED_FILTER, before: Callable[[int], None] | None = None) -> DataFrame:
    """Run ``n_trials`` seeded trials over ``train_all`` (the whole training frame with folds); the rows of ``trial_table``, one a trial.

    Each trial's row is written as soon as it ends, so a search that is started again on the same table goes on
    after the trials it holds. A trial first fits the models that leave out the first fold; if their raw score is above
    ``abandon_above`` it ends there, else the other folds' models are fitted together. ``tree_budget`` scales the drawn tree counts and
    ``step_scale`` the shrinkage (fewer trees with a larger step for quick runs); both are 1 by default. ``before`` is called with the
    number of each trial about to run."""
    spark = train_all.sparkSession
    folds, rules = list(folds), ["raw", "inactive", "invariant"]
    for n, t in enumerate(draw_trials(n_trials, seed, filter_override)):
        if _finished(spark, trial_table, n):
            continue
        if before:
            before(n)
        trees = max(1, int(round(t.trees * tree_budget)))
        step = min(1.0, t.shrinkage * step_scale)
        one = Spec(trees, step, t.bagfrac, t.depth, loss=t.distrib, df=t.df, seed=seed + n)

        def scores(some: list[int]) -> DataFrame:
            preds, _ = boosted_folds(train_all, [one], spec, t.filter, some)
            return E.rmsle(side_by_side(preds, spec, rules), by=["adjustment", "fold"])

        got = scores(folds[:1]).collect()
        abandoned = next(r.rmsle for r in got if r.adjustment == "raw") > abandon_above
        if not abandoned and folds[1:]:
            got += scores(folds[1:]).collect()
        by = {a: [r.rmsle for r in sorted(got, key=lambda r: r.fold) if r.adjustment == a] for a in rules}
        mean = {a: sum(v) / len(v) for a, v in by.items()}
        rec = asdict(t) | {"trial": n, "trees_run": trees, "step_run": step, "abandoned": abandoned, "sum_raw": sum(by["raw"]), "date": stamp(_dt.date.today())}
        rec |= {f"mean_{a}": mean[a] for a in rules} | {f"accept_{a}": not abandoned and mean[a] < threshold for a in rules}
        row = spark.createDataFrame([tuple(rec[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA)
        row.write.mode("overwrite").parquet(f"{trial_table}/part={n}")
    return spark.read.schema(SCHEMA).parquet(trial_table).select(*[c.split()[0] for c in SCHEMA.split(", ")])
