"""Model families behind one interface: ``fit(train) -> model``, ``model.predict(df)``.

Every family is a ``pyspark.ml`` pipeline (design matrix + estimator), so the
fit runs as distributed Spark jobs and scoring is a ``transform``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any, Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .design import NON_FEATURES, design_pipeline, tree_bins, non_constant, scaler, slot_names, source_of, split_columns
from .kernels import fourier_features


def gbm_depth(interaction_depth: int) -> int:
    """Tree depth with about as many leaves as ``interaction_depth`` splits give (k splits -> k + 1 leaves)."""
    return max(1, math.ceil(math.log2(interaction_depth + 1)))


@dataclass
class Fitted:
    """A fitted pipeline plus a scoring function returning (account_id, prediction)."""

    model: Any
    predict_fn: Callable[[DataFrame], DataFrame]
    info: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.predict_fn(df)


def _score(model: PipelineModel, keep: Sequence[str] = ("account_id",)) -> Callable[[DataFrame], DataFrame]:
    def f(df: DataFrame) -> DataFrame:
        return model.transform(df).select(*keep, F.col("prediction").cast("double").alias("prediction"))
    return f


def fit_linear(train: DataFrame, label: str = "total", reg: float = 1e-6) -> Fitted:
    """Ordinary least squares on ``label ~ .`` (a tiny ridge keeps collinear columns solvable)."""
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                          solver="normal", standardization=True)
    m = Pipeline(stages=[design_pipeline(train), lr]).fit(train)
    return Fitted(m, _score(m))


def fit_gbt(train: DataFrame, label: str = "total", trees: int = 100, shrinkage: float = 0.1, bagfrac: float = 0.5,
            depth: int = 3, minobsinnode: int = 5, distrib: str = "gaussian", seed: int = 551724) -> Fitted:
    """Boosted regression trees with squared (gaussian) or absolute (laplace) loss."""
    loss = {"gaussian": "squared", "laplace": "absolute"}[distrib]
    design = design_pipeline(train, one_hot=False).fit(train)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=trees, stepSize=shrinkage,
                       subsamplingRate=bagfrac, maxDepth=gbm_depth(depth), minInstancesPerNode=minobsinnode,
                       lossType=loss, seed=seed, maxBins=tree_bins(design), cacheNodeIds=True, checkpointInterval=10)
    m = PipelineModel(stages=[*design.stages, gbt.fit(design.transform(train))])
    return Fitted(m, _score(m), {"importances_model": m.stages[-1]})


def fit_forest(train: DataFrame, label: str = "total", trees: int = 300, depth: int = 5, seed: int = 551724) -> Fitted:
    """Mean prediction of an ensemble of randomised trees."""
    design = design_pipeline(train, one_hot=False).fit(train)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth,
                               featureSubsetStrategy="onethird", subsamplingRate=1.0, seed=seed,
                               maxBins=tree_bins(design))
    m = PipelineModel(stages=[*design.stages, rf.fit(design.transform(train))])
    return Fitted(m, _score(m), {"importances_model": m.stages[-1]})


def _kernel_design(train: DataFrame) -> tuple[PipelineModel, list[str]]:
    num, _ = split_columns(train)
    keep = non_constant(train, num)
    drop = [c for c in num if c not in keep]
    t = train.drop(*drop)
    design = Pipeline(stages=[design_pipeline(t), scaler("features", "scaled")]).fit(t)
    return design, drop


def fit_rff_regression(train: DataFrame, label: str = "total", cost: float = 20.0, gamma: float = 0.025,
                       n_components: int = 200, seed: int = 7) -> Fitted:
    """Radial-kernel regression approximated by random Fourier features + robust (huber) linear fit."""
    design, drop = _kernel_design(train)
    t = design.transform(train.drop(*drop))
    dim = len(t.select("scaled").first()[0])
    # the Fourier map runs once; the iterative solver then reads the persisted rows
    t = fourier_features(t, "scaled", "rff", dim, gamma, n_components, seed).select("rff", label).persist()
    lr = LinearRegression(featuresCol="rff", labelCol=label, loss="huber", regParam=1.0 / (cost * 10.0),
                          elasticNetParam=0.0, maxIter=100)
    m = lr.fit(t)
    t.unpersist()

    def predict(df: DataFrame) -> DataFrame:
        s = design.transform(df.drop(*[c for c in drop if c in df.columns]))
        s = fourier_features(s, "scaled", "rff", dim, gamma, n_components, seed)
        return m.transform(s).select("account_id", F.col("prediction").cast("double").alias("prediction"))

    return Fitted(m, predict)


def fit_rff_classifier(train: DataFrame, label: str = "total", cost: float = 100.0, gamma: float = 0.001,
                       n_components: int = 200, seed: int = 7) -> Fitted:
    """Multi-class support-vector classification on the label as a class (one-vs-rest, RFF map)."""
    design, drop = _kernel_design(train)
    t = design.transform(train.drop(*drop))
    dim = len(t.select("scaled").first()[0])
    t = fourier_features(t, "scaled", "rff", dim, gamma, n_components, seed)
    t = t.select("rff", F.col(label).cast("string").alias("label_class"))
    idx = StringIndexer(inputCol="label_class", outputCol="label_idx", stringOrderType="alphabetAsc").fit(t)
    ovr = OneVsRest(classifier=LinearSVC(regParam=1.0 / cost, maxIter=25), featuresCol="rff",
                    labelCol="label_idx", predictionCol="class_idx", parallelism=2)
    # the Fourier map runs once; every one-vs-rest solver iteration reads the persisted rows
    fit_rows = idx.transform(t).persist()
    m = ovr.fit(fit_rows)
    fit_rows.unpersist()
    back = IndexToString(inputCol="class_idx", outputCol="class_label", labels=idx.labels)

    def predict(df: DataFrame) -> DataFrame:
        s = design.transform(df.drop(*[c for c in drop if c in df.columns]))
        s = fourier_features(s, "scaled", "rff", dim, gamma, n_components, seed)
        out = back.transform(m.transform(s))
        return out.select("account_id", F.col("class_label").try_cast("double").alias("prediction"))

    return Fitted(m, predict)


def importances(fitted: Fitted, train: DataFrame) -> list[tuple[str, float]]:
    """Relative influence (%) per source column, one-hot slots summed back, descending."""
    tree = fitted.info.get("importances_model")
    if tree is None:
        return []
    design = PipelineModel(stages=fitted.model.stages[:-1])
    names = slot_names(design.transform(train.limit(1)), "features")
    imp = tree.featureImportances.toArray()
    agg: dict[str, float] = {}
    for n, v in zip(names, imp):
        agg[source_of(n)] = agg.get(source_of(n), 0.0) + float(v)
    tot = sum(agg.values()) or 1.0
    return sorted(((k, 100.0 * v / tot) for k, v in agg.items()), key=lambda kv: -kv[1])
