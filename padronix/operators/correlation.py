"""Correlation tables and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.operators.cleaning import complete_cases


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 3) -> DataFrame:
    """Pearson correlation of every ordered pair on complete cases, by one aggregate."""
    pairs = list(combinations(cols, 2))
    rows = complete_cases(df, cols).agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    items = []
    for i, (a, b) in enumerate(pairs):
        r = F.col(f"r{i}") if digits is None else F.round(f"r{i}", digits)
        items += [F.struct(F.lit(p).alias("var1"), F.lit(q).alias("var2"), r.alias("r")) for p, q in ((a, b), (b, a))]
    items += [F.struct(F.lit(c).alias("var1"), F.lit(c).alias("var2"), F.lit(1.0).alias("r")) for c in cols]
    return rows.select(F.inline(F.array(*items)))


def corr_rank(df: DataFrame, target: str, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Variables by absolute correlation with the target, strongest first."""
    others = [c for c in cols if c != target]
    rows = complete_cases(df, [target, *others]).agg(*[F.corr(c, target).alias(c) for c in others])
    long = rows.unpivot([], others, "variable", "r")
    return long.select("variable", F.round("r", digits).alias("r")).orderBy(F.desc(F.abs("r")), "variable")


PANEL = 128  # positions that are eliminated before the rest of the matrix is brought up to date


def _dependent(r: np.ndarray, variance: np.ndarray, tolerance: float) -> list[int]:
    """Positions that are constant or a linear function of earlier ones, by elimination on a k x k matrix.

    A panel of positions is eliminated row by row; the rows behind it are updated by one matrix product.
    """
    m = np.array(r, float)
    constant = ~(np.asarray(variance) > 0)
    m[constant, :] = m[:, constant] = 0.0
    k = len(m)
    dropped = []
    for low in range(0, k, PANEL):
        high = min(low + PANEL, k)
        pivots = []
        for i in range(low, high):
            if not m[i, i] > tolerance:
                dropped.append(i)
                continue
            pivots.append(i)
            m[i + 1 : high, i:] -= np.outer(m[i, i + 1 : high] / m[i, i], m[i, i:])
        if pivots and high < k:
            rows = m[pivots, high:]
            m[high:, high:] -= (rows / m[pivots, pivots][:, None]).T @ rows
    return dropped


def aliased_positions(df: DataFrame, features: str, tolerance: float = 1e-9) -> list[int]:
    """Positions of a vector column that are constant or a linear function of earlier ones."""
    spread = df.select(Summarizer.variance(F.col(features)).alias("v")).first()["v"].toArray()
    r = Correlation.corr(df, features).first()[0].toArray()
    return _dependent(r, spread, tolerance)


def aliased_columns(df: DataFrame, cols: Sequence[str], tolerance: float = 1e-9) -> list[str]:
    """Columns that are constant or a linear function of earlier ones, on complete cases."""
    cols = list(cols)
    rows = VectorAssembler(inputCols=cols, outputCol="_x", handleInvalid="skip").transform(df).select("_x")
    return [cols[i] for i in aliased_positions(rows, "_x", tolerance)]


def principal_components(df: DataFrame, cols: Sequence[str], k: int) -> tuple[DataFrame, DataFrame]:
    """Explained variance per component, and the loading of every variable on it."""
    rows = complete_cases(df, cols)
    assembled = VectorAssembler(inputCols=list(cols), outputCol="raw").transform(rows).select("raw")
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="z").fit(assembled)
    model = PCA(k=k, inputCol="z", outputCol="pc").fit(scaled.transform(assembled))
    spark, weights, cumulative = df.sparkSession, model.pc, 0.0
    variance, loadings = [], []
    for j, share in enumerate(model.explainedVariance.toArray()):
        cumulative += float(share)
        variance.append((j + 1, float(share), cumulative))
        loadings += [(c, j + 1, float(weights[i, j])) for i, c in enumerate(cols)]
    return (
        spark.createDataFrame(variance, "component int, explained double, cumulative double"),
        spark.createDataFrame(loadings, "variable string, component int, loading double"),
    )
