"""Local regression with its standard error, from sums per bin of x."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.functions.values import equal_width_bin

SCHEMA = "point int, x double, fit double, se double, low double, high double"


def _weights(at: np.ndarray, x: np.ndarray, n: np.ndarray, span: float) -> np.ndarray:
    """Tricube weights of the nearest `span` of the rows, one row per place; beyond 1, of all rows at a wider reach."""
    apart = np.abs(at[:, None] - x[None, :])
    order = np.argsort(apart, axis=1, kind="stable")
    rows = np.cumsum(n[order], axis=1)
    wanted = max(1, math.floor(n.sum() * min(span, 1.0) + 1e-5))
    last = np.argmax(rows >= wanted, axis=1)
    reach = np.take_along_axis(apart, np.take_along_axis(order, last[:, None], 1), 1) * max(span, 1.0)
    near = np.divide(apart, reach, out=np.where(apart > 0, 1.0, 0.0), where=reach > 0)
    return np.where(near < 1, (1 - np.minimum(near, 1) ** 3) ** 3, 0.0) * n


def _operator(at: np.ndarray, x: np.ndarray, n: np.ndarray, span: float, degree: int) -> np.ndarray:
    """The matrix that turns bin means into fitted values at `at`."""
    out = np.zeros((len(at), len(x)))
    for i, weights in enumerate(_weights(at, x, n, span)):
        used = np.flatnonzero(weights)
        gap = x[used] - at[i]
        design = np.vander(gap / (np.abs(gap).max() or 1.0), degree + 1, increasing=True)
        root = np.sqrt(weights[used])
        out[i, used] = np.linalg.pinv(design * root[:, None])[0] * root
    return out


def local_regression(
    df: DataFrame, x: str, y: str, span: float = 0.75, degree: int = 2, points: int = 80, bins: int = 1024,
    z: float = 1.96, digits: int = 6,
) -> DataFrame:
    """Local polynomial of y along x at `points` evenly spaced places, with its standard error and a band of `z` errors.

    One pass gives rows, mean x, mean y and the squares of y around it for each of `bins` equal parts of x; all rows
    of a part count at its mean x. With at most one value of x per part the result is that of the rows themselves.
    The nearest `span` of the rows get tricube weights; the residual variance is the sum of squares over the trace of
    (I - L)(I - L)'. Fits run on the driver on the `bins` sums, whatever the number of rows. Rows with a null or NaN
    are left out; without rows the result is empty, and without degrees of freedom the errors are null.
    """
    rows = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).na.drop()
    ends = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("r")).scalar()
    binned = rows.withColumn("_r", ends).groupBy(equal_width_bin(F.col("_x"), F.col("_r.lo"), F.col("_r.hi"), bins).alias("bin"))
    sums = binned.agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("_x").alias("x"), F.avg("_y").alias("y"), F.var_pop("_y").alias("v"),
        F.min("_x").alias("lo"), F.max("_x").alias("hi"),
    ).orderBy("x").toPandas()
    if sums.empty:
        return df.sparkSession.createDataFrame([], SCHEMA)
    n, mean_x, mean_y = (sums[c].to_numpy() for c in ("n", "x", "y"))
    own = _operator(mean_x, mean_x, n, span, degree)
    within = float((sums["v"].to_numpy() * n).sum())
    squares = within + float((n * (mean_y - own @ mean_y) ** 2).sum())
    # per row, the operator's entry is that of the row's bin over the bin's rows
    freedom = float(n.sum() - 2 * np.trace(own) + (n[:, None] * own**2 / n[None, :]).sum())
    places = np.linspace(sums["lo"].min(), sums["hi"].max(), points)
    matrix = _operator(places, mean_x, n, span, degree)
    fit = matrix @ mean_y
    sure = freedom > 1e-9
    se = np.sqrt(squares / freedom * (matrix**2 / n[None, :]).sum(axis=1)) if sure else None
    out = []
    for i in range(points):
        error = float(se[i]) if sure else None
        band = (float(fit[i] - z * error), float(fit[i] + z * error)) if sure else (None, None)
        out.append((i, float(places[i]), float(fit[i]), error, *band))
    made = df.sparkSession.createDataFrame(out, SCHEMA)
    return made.select("point", *[F.round(c, digits).alias(c) for c in ("x", "fit", "se", "low", "high")])
