"""Local regression against a direct fit of the rows."""

import numpy as np
import pytest

from padronix.operators.local_regression import local_regression


def direct(x, y, places, span, degree):
    """Fit and standard error by the definition: one operator row per place, rows taken one by one."""
    def operator(at):
        out = np.zeros((len(at), len(x)))
        for i, p in enumerate(at):
            gap = np.abs(x - p)
            reach = np.sort(gap)[max(1, int(len(x) * min(span, 1) + 1e-5)) - 1] * max(span, 1)
            w = np.where(gap < reach, (1 - (gap / reach) ** 3) ** 3, 0)
            a = np.column_stack([(x - p) ** k for k in range(degree + 1)])
            out[i] = np.linalg.solve(a.T @ (a * w[:, None]), a.T * w)[0]
        return out

    smooth = operator(x)
    rest = np.eye(len(x)) - smooth
    sigma2 = ((rest @ y) ** 2).sum() / np.trace(rest @ rest.T)
    at = operator(places)
    return at @ y, np.sqrt(sigma2 * (at**2).sum(axis=1))


@pytest.mark.parametrize(("span", "degree"), [(0.75, 2), (0.3, 1), (1.5, 2)])
def test_equals_a_direct_fit(spark, span, degree):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 30, 150).astype(float)
    y = np.sin(x / 5) + rng.normal(0, 0.3, 150)
    df = spark.createDataFrame([*zip(x.tolist(), y.tolist()), (None, 1.0), (3.0, None)], "x double, y double")
    got = local_regression(df, "x", "y", span, degree, points=11, digits=10).toPandas()
    fit, se = direct(x, y, np.linspace(x.min(), x.max(), 11), span, degree)
    np.testing.assert_allclose(got["fit"], fit, atol=1e-7)
    np.testing.assert_allclose(got["se"], se, atol=1e-7)
    np.testing.assert_allclose(got["high"] - got["low"], 2 * 1.96 * se, atol=1e-6)


def test_bins_come_close_to_the_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 10, 400)
    y = np.sin(x) + rng.normal(0, 0.2, 400)
    df = spark.createDataFrame([*zip(x.tolist(), y.tolist())], "x double, y double")
    got = local_regression(df, "x", "y", points=9, bins=200).toPandas()
    fit, se = direct(x, y, np.linspace(x.min(), x.max(), 9), 0.75, 2)
    assert np.abs(got["fit"] - fit).max() < 0.01 and np.abs(got["se"] - se).max() < 0.01


def test_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert [tuple(r) for r in local_regression(df, "x", "y", points=2).collect()] == [(0, 1.0, 2.0, None, None, None), (1, 1.0, 2.0, None, None, None)]
    assert local_regression(df.limit(0), "x", "y").count() == 0
