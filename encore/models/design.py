"""Design matrix for ``label ~ .``: categorical columns one-hot, numeric columns as is."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (OneHotEncoder, PolynomialExpansion, SQLTransformer, StandardScaler,
                                StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NON_FEATURES = ("account_id", "total", "label", "fold", "prediction")


def split_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> tuple[list[str], list[str]]:
    """(numeric feature columns, categorical feature columns)."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (cat if isinstance(f.dataType, StringType) else num).append(f.name)
    return num, cat


def design_pipeline(df: DataFrame, exclude: Sequence[str] = NON_FEATURES, out: str = "features",
                    one_hot: bool = True) -> Pipeline:
    """StringIndexer (unseen/NA kept as their own index) -> OneHotEncoder -> VectorAssembler."""
    num, cat = split_columns(df, exclude)
    stages = []
    idx = [f"{c}__idx" for c in cat]
    if cat:
        # blank text is a level of its own; ML attribute names may not be empty
        fix = ", ".join(f"CASE WHEN `{c}` = '' THEN '__blank__' ELSE `{c}` END AS `{c}__lvl`" for c in cat)
        stages.append(SQLTransformer(statement=f"SELECT *, {fix} FROM __THIS__"))
        stages.append(StringIndexer(inputCols=[f"{c}__lvl" for c in cat], outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        if one_hot:
            oh = [f"{c}__oh" for c in cat]
            stages.append(OneHotEncoder(inputCols=idx, outputCols=oh, handleInvalid="keep", dropLast=True))
            idx = oh
    stages.append(VectorAssembler(inputCols=num + idx, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)


def source_of(feature_name: str) -> str:
    """Map an assembled slot name back to its source column."""
    for suf in ("__oh", "__idx", "__lvl"):
        if suf in feature_name:
            return feature_name.split(suf)[0]
    return feature_name


def slot_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the assembled vector's slots (from the ML attribute metadata)."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots: dict[int, str] = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a["name"]
    n = meta.get("num_attrs", len(slots))
    return [slots.get(i, f"f{i}") for i in range(n)]


def non_constant(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Numeric columns whose standard deviation is not 0 (one aggregate job)."""
    if not cols:
        return []
    row = df.agg(*[F.stddev_pop(F.col(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > 0]


def scaler(inp: str = "features", out: str = "scaled") -> StandardScaler:
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def log_polynomial(df: DataFrame, cols: Sequence[str], degree: int = 2, out: str = "poly") -> tuple[DataFrame, PolynomialExpansion]:
    """Polynomial terms of log(1 + x) columns (off by default in the drivers)."""
    tmp = df.select("*", *[F.log1p(F.col(c)).alias(f"{c}__log") for c in cols])
    va = VectorAssembler(inputCols=[f"{c}__log" for c in cols], outputCol=f"{out}__in")
    return va.transform(tmp), PolynomialExpansion(degree=degree, inputCol=f"{out}__in", outputCol=out)


def fit_design(df: DataFrame, exclude: Sequence[str] = NON_FEATURES, one_hot: bool = True) -> PipelineModel:
    return design_pipeline(df, exclude, one_hot=one_hot).fit(df)


def tree_bins(design: PipelineModel, least: int = 32) -> int:
    """Bins that tree learners need: one for each level of the widest factor, unseen values included."""
    levels = [len(labels) + 1 for st in design.stages if isinstance(st, StringIndexerModel) for labels in st.labelsArray]
    return max([least, *levels])
