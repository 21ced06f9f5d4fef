"""K-fold cross-validation with the prediction adjustments scored side by side.

Folds are a column; each fold's fit is a ``pyspark.ml`` job over the training
rows, its predictions a ``transform``. All fold predictions are unioned into one
long (fold, adjustment, prediction, label) frame that a single aggregation turns
into the per-adjustment fold means; only those few numbers reach the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from itertools import product
from typing import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..models.boosting import Boosted, Spec, fit_boosted
from ..models.design import NON_FEATURES
from ..models.forest import fit_forests
from ..models.fourier import fit_class_folds, fit_huber_folds, fourier_folds
from ..models.machines import Kernel, Machine, Machines, fit_machines
from ..models.regressors import Fitted
from ..operators import adjust as X
from ..operators import evaluate as E
from ..operators.features import matching_columns
from ..operators.split import clean_outliers, split
from ..spec import HistorySpec, suffix

FitFn = Callable[[DataFrame], Fitted]


@dataclass
class CVResult:
    scores: DataFrame            # adjustment, mean_rmsle, sum_rmsle, folds
    predictions: DataFrame       # fold, account_id, total, prediction (raw)
    abandoned: bool = False
    first_fold_rmsle: float | None = None


def cross_validate(train: DataFrame, fit: FitFn, history: DataFrame, spec: HistorySpec,
                   folds: Iterable[int] = range(1, K.NUM_FOLDS + 1), clean: bool = False,
                   abandon_above: float | None = None, adjustments: Sequence[str] | None = None,
                   label: str = "total", log_scale: bool = False, parallelism: int = 1) -> CVResult:
    """Fit and score every fold; ``parallelism`` > 1 submits fold fits as concurrent Spark jobs.

    With ``abandon_above`` the first fold runs alone and ends the run when its raw
    RMSLE is above the threshold."""
    last = f"total_{suffix(spec.last_season)}"
    folds = list(folds)

    def one(fold: int) -> DataFrame:
        tr, va = split(train, fold)
        if clean:
            tr = clean_outliers(tr, last, label)
        model = fit(tr)
        return model.predict(va).join(va.select("account_id", label), "account_id").withColumn("fold", F.lit(fold))

    parts: list[DataFrame] = []
    first = None
    rest = folds
    if abandon_above is not None and folds:
        p = one(folds[0])
        first = E.rmsle(p, "prediction", label, log_scale).first()["rmsle"]
        if first > abandon_above:
            return CVResult(E.fold_scores(_long(p, history, spec, ["raw"]), label=label, log_scale=log_scale),
                            p, True, first)
        parts.append(p)
        rest = folds[1:]
    if parallelism > 1 and len(rest) > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as ex:
            parts.extend(ex.map(one, rest))
    else:
        parts.extend(one(f) for f in rest)
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    adj = list(adjustments) if adjustments else list(X.all_adjustments(F.col("prediction"), spec))
    scores = E.fold_scores(_long(preds, history, spec, adj), label=label, log_scale=log_scale)
    return CVResult(scores, preds, False, first)


def _long(preds: DataFrame, history: DataFrame, spec: HistorySpec, adjustments: Sequence[str]) -> DataFrame:
    h = X.with_history(preds, history, spec)
    rules = X.all_adjustments(F.col("prediction"), spec)
    wide = h.select("fold", "total", *[rules[a].alias(a) for a in adjustments])
    return wide.unpivot(["fold", "total"], list(adjustments), "adjustment", "prediction")


def grid_search(train: DataFrame, make_fit: Callable[..., FitFn], grid: dict[str, Sequence], history: DataFrame,
                spec: HistorySpec, folds: Iterable[int], parallelism: int = 2) -> DataFrame:
    """Cross-validated raw RMSLE for every parameter combination (combinations run as concurrent jobs)."""
    keys = list(grid)
    combos = [dict(zip(keys, vals)) for vals in product(*[grid[k] for k in keys])]
    folds = list(folds)

    def run(params: dict) -> tuple:
        r = cross_validate(train, make_fit(**params), history, spec, folds, adjustments=["raw"])
        row = r.scores.where(F.col("adjustment") == "raw").first()
        return tuple(float(params[k]) for k in keys) + (float(row["mean_rmsle"]),)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        rows = list(ex.map(run, combos))
    schema = ", ".join(f"{k} double" for k in keys) + ", mean_rmsle double"
    return train.sparkSession.createDataFrame(rows, schema)


def history_columns(spec: HistorySpec) -> list[str]:
    """Columns that the adjustment rules read."""
    return [*[f"total_{suffix(s)}" for s in spec.history_seasons], "State", "dSF"]


def side_by_side(preds: DataFrame, spec: HistorySpec, adjustments: Sequence[str] | None = None, label: str = "total",
                 more: Sequence[str] = ()) -> DataFrame:
    """(more..., fold, label, adjustment, prediction): ``preds``, which carry label and history columns, under each rule; no join."""
    rules = X.all_adjustments(F.col("prediction"), spec)
    names = list(adjustments) if adjustments else list(rules)
    ids = [*more, "fold", label]
    return preds.select(*ids, *[rules[a].alias(a) for a in names]).unpivot(ids, names, "adjustment", "prediction")


def boosted_folds(train: DataFrame, specs: Sequence[Spec], spec: HistorySpec, filter_regex: str = "", folds: Iterable[int] = range(1, K.NUM_FOLDS + 1),
                  clean: bool = False, label: str = "total") -> tuple[DataFrame, Boosted]:
    """Every fold's rows scored by models that have not seen them: (account_id, fold, label, history columns, setting, prediction), where
    ``setting`` numbers ``specs``. The models of all settings and folds are fitted in the same passes over the rows, and label and
    history travel with the row, so nothing is joined back. ``train`` is the whole training frame; ``filter_regex`` names features to leave out."""
    folds = list(folds)
    rows = train.where(F.col("fold").isin(folds)) if set(folds) != set(range(1, K.NUM_FOLDS + 1)) else train
    every = [replace(s, out=f) for s in specs for f in folds]
    data = clean_outliers(train, f"total_{suffix(spec.last_season)}", label) if clean else train
    gone = matching_columns(train.columns, filter_regex) if filter_regex else []
    m = fit_boosted(data, every, label, exclude=[*NON_FEATURES, *gone])
    at = F.array_position(F.array(*[F.lit(f) for f in folds]), F.col("fold")).cast("int") - 1
    keep = ["account_id", "fold", label, *history_columns(spec)]
    parts = [m.predict(rows, at + i * len(folds), keep).withColumn("setting", F.lit(i)) for i in range(len(specs))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, m


def machine_folds(scaled: DataFrame, kernels: Sequence[Kernel], settings: Sequence[Machine], folds: Iterable[int] = range(1, K.NUM_FOLDS + 1),
                  label: str = "total", learn=None, keep: Sequence[str] = ("account_id", "fold", "total"), **how) -> tuple[DataFrame, Machines]:
    """(keep..., scores): each row's scores by the machines that leave its fold out (setting by setting). The machines of all settings
    and folds are fitted in the same passes; only rows that meet ``learn`` are learned from."""
    folds = list(folds)
    every = [replace(s, out=f) for f in folds for s in settings]
    m = fit_machines(scaled if learn is None else scaled.where(learn), kernels, every, label=label, **how)
    n = len(settings)
    at = (F.array_position(F.array(*[F.lit(f) for f in folds]), F.col("fold")).cast("int") - 1) * n
    of = F.when(at >= 0, F.sequence(at, at + n - 1)).otherwise(F.array().cast("array<int>"))
    got = m.scores(scaled, "scaled", keep, of)
    return got.withColumn("scores", F.filter("scores", lambda s: s.isNotNull())), m


def _own_fold(numbers: dict[int, list[int]]):
    """Array of the numbers of the machines that leave out a row's fold."""
    every = F.create_map(*[x for f, n in numbers.items() for x in (F.lit(f), F.array(*[F.lit(i) for i in n]).cast("array<int>"))])
    return F.coalesce(F.try_element_at(every, F.col("fold").cast("int")), F.array().cast("array<int>"))


def huber_folds(train: DataFrame, gamma: float, reg: float, n_components: int = 200, folds: Iterable[int] = range(1, K.NUM_FOLDS + 1),
                columns: Sequence[str] | None = None, keep: Sequence[str] = ("account_id", "fold", "total")) -> DataFrame:
    """(keep..., prediction): each row by the radial-kernel regression (random Fourier map, huber loss) fitted on the other folds; the fits of
    all folds share their passes over the rows. ``columns`` names the features."""
    folds = list(folds)
    data = fourier_folds(train, folds, gamma, n_components, columns=columns)
    m, _, _ = fit_huber_folds(data, reg)
    data.packed.unpersist()
    rows = data.vectors(train.where(F.col("fold").isin(folds)), keep)
    got = m.scores(rows, "design", keep, _own_fold({f: [i] for i, f in enumerate(folds)}))
    return got.select(*keep, F.filter("scores", lambda s: s.isNotNull())[0].alias("prediction"))


def class_folds(train: DataFrame, gamma: float, reg: float, n_components: int, folds: Iterable[int] = range(1, K.NUM_FOLDS + 1),
                columns: Sequence[str] | None = None, learn=None, keep: Sequence[str] = ("account_id", "fold", "total"), label: str = "total") -> DataFrame:
    """(keep..., prediction): each row's class by the support-vector machines (random Fourier map, one class against all others) fitted on the
    rows of the other folds that meet ``learn``; all share their passes over the rows. The largest score wins, then the class first by name."""
    folds = list(folds)
    data = fourier_folds(train, folds, gamma, n_components, label=label, columns=columns, learn=learn)
    seen = (train if learn is None else train.where(learn)).where(F.col(label).isNotNull()).select("fold", F.col(label).cast("double").alias("c")).distinct().collect()
    classes = {f: sorted({r.c for r in seen if r.fold != f}, key=str) for f in folds}  # whole numbers of subscriptions
    m, _ = fit_class_folds(data, classes, reg)
    data.packed.unpersist()
    of = {f: [j for j, x in enumerate(m.machines) if x.out == f] for f in folds}
    rows = data.vectors(train.where(F.col("fold").isin(folds)), keep)
    got = m.scores(rows, "design", keep, _own_fold(of)).withColumn("scores", F.filter("scores", lambda s: s.isNotNull()))
    names = F.create_map(*[x for f in folds for x in (F.lit(f), F.array(*[F.lit(c) for c in classes[f]]))])
    best = F.array_position("scores", F.array_max("scores")).cast("int")
    return got.select(*keep, F.element_at(F.element_at(names, F.col("fold").cast("int")), best).alias("prediction"))


def forest_folds(train: DataFrame, trees: int, depth: int, filter_regex: str = "", folds: Iterable[int] = range(1, K.NUM_FOLDS + 1),
                 keep: Sequence[str] = ("account_id", "fold", "total"), label: str = "total") -> DataFrame:
    """(keep..., prediction): each row by the forest that has not seen its fold; the forests of all folds grow in the same passes.
    ``filter_regex`` names features to leave out."""
    folds = list(folds)
    gone = matching_columns(train.columns, filter_regex) if filter_regex else []
    m = fit_forests(train, folds, trees, depth, label=label, exclude=[*NON_FEATURES, *gone])
    at = F.array_position(F.array(*[F.lit(f) for f in folds]), F.col("fold")).cast("int") - 1
    return m.predict(train.where(F.col("fold").isin(folds)), at, keep)
