"""Random Fourier features: a column job approximating an RBF kernel machine.

z(x) = sqrt(2/D) * cos(W x + b), W ~ N(0, 2*gamma), b ~ U(0, 2*pi). The map is
applied in Arrow batches (numpy matmul per batch); W has D x d entries, fixed by
the parameters and independent of the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def draws(dim: int, gamma: float, n_components: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(W, b) of a map of ``dim`` columns."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 * gamma), size=(dim, n_components)), rng.uniform(0.0, 2 * np.pi, size=n_components)


def fourier_features(df: DataFrame, inp: str, out: str, dim: int, gamma: float, n_components: int = 200,
                     seed: int = 7) -> DataFrame:
    w, b = draws(dim, gamma, n_components, seed)
    scale = np.sqrt(2.0 / n_components)

    @F.pandas_udf(ArrayType(DoubleType()))
    def rff(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        m = np.vstack(x.to_numpy())
        z = scale * np.cos(m @ w + b)
        return pd.Series(list(z))

    return df.withColumn(out, array_to_vector(rff(vector_to_array(F.col(inp)))))
