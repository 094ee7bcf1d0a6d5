"""Screening of model inputs for collinearity."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame

from serpscope import schema as S


def inflation(corr: np.ndarray, i: int) -> float:
    """Variance inflation of one feature given the others."""
    others = [j for j in range(len(corr)) if j != i]
    if not others:
        return 1.0
    r = corr[i, others]
    explained = float(r @ np.linalg.pinv(corr[np.ix_(others, others)]) @ r)
    return float("inf") if explained > 1 - 1e-9 else 1.0 / (1.0 - explained)


def collinearity_vif(
    matrix: DataFrame, columns: list[str] | None = None, limit: float = S.VIF_LIMIT
) -> DataFrame:
    """Inflation per feature; the worst is dropped until all are within the limit. The data is
    read once, for the correlation matrix; the rest is arithmetic on k x k numbers."""
    columns = columns or S.FEATURES
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(matrix).select("v")
    corr = np.nan_to_num(Correlation.corr(vectors, "v").first()[0].toArray())
    np.fill_diagonal(corr, 1.0)
    first = [inflation(corr, i) for i in range(len(columns))]
    kept = list(range(len(columns)))
    while len(kept) > 1:
        current = [inflation(corr[np.ix_(kept, kept)], i) for i in range(len(kept))]
        worst = int(np.argmax(current))
        if current[worst] <= limit:
            break
        kept.pop(worst)
    rows = [(c, first[i], i in kept) for i, c in enumerate(columns)]
    return matrix.sparkSession.createDataFrame(rows, "feature string, vif double, kept boolean")
