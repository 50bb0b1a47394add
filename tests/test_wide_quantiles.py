"""Quantiles of many columns by wide passes, against numpy; sketches so small that they err."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from padronix.operators import quality, stats
from padronix.operators import wide_quantiles as module
from padronix.operators.wide_quantiles import wide_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def drawn(seed, n):
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "wide": rng.lognormal(0, 3, n),
            "ties": rng.integers(0, 5, n).astype(float),
            "halves": np.repeat([1.0, 2.0], n // 2),  # the median lies between the two values
            "mostly_one": np.where(rng.random(n) < 0.9, 7.0, rng.normal(0, 1, n)),
            "ordered": np.arange(n, dtype=float),
            "ends": np.where(rng.random(n) < 0.3, -np.inf, rng.normal(0, 1, n)),
        }
    )


def compare(spark, data, partitions=4, **options):
    df = spark.createDataFrame(data).repartition(partitions)
    got = {r.variable: [r[f"q{i}"] for i in range(len(PROBS))] for r in wide_quantiles(df, list(data), PROBS, **options).collect()}
    for c in data:
        with np.errstate(invalid="ignore"):
            ranked = np.sort(data[c].to_numpy())
            position = (len(ranked) - 1) * np.array(PROBS)
            low, high = ranked[np.floor(position).astype(int)], ranked[np.ceil(position).astype(int)]
            want = low + (high - low) * (position - np.floor(position))
        np.testing.assert_array_equal(np.array(got[c]), want, err_msg=c)


@pytest.mark.parametrize("k", [60, 200, 4096])
def test_equals_sorted_values_at_any_size_of_sketch(spark, k):
    compare(spark, drawn(k, 5000), k=k)


@pytest.mark.parametrize("wrong", [0.0, 1.0])
def test_marks_beside_the_rank_cost_passes_only(spark, monkeypatch, wrong):
    """Marks are forced to one end of every span, so the rank always lies beyond them."""
    looked_up = module._looked_up
    monkeypatch.setattr(module, "_looked_up", lambda df, asked: looked_up(df, [(s, at if len(at) == 1 else [wrong, wrong]) for s, at in asked]))
    compare(spark, drawn(5, 60)[["wide", "ties"]], k=50)


@pytest.mark.parametrize("n", [2, 4, 6])
def test_small_tables(spark, n):
    compare(spark, drawn(n, n), partitions=1)


def test_missing_values_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), float("nan")), (3.0, None)], "a double, b double")
    rows = {r.variable: r for r in wide_quantiles(df, ["a", "b"], [0.5], {"n": F.count}).collect()}
    assert (rows["a"].q0, rows["a"].n, rows["b"].q0, rows["b"].n) == (2.0, 3, None, 1)
    none = wide_quantiles(df.limit(0), ["a"], [0.5], {"n": F.count}, {"top": lambda v, lo, hi: F.count_if(v == hi)}).collect()
    assert [(r.variable, r.n, r.top, r.q0) for r in none] == [("a", 0, 0, None)]


def passes(monkeypatch):
    """Aggregates that run from here on."""
    ran, agg = [], DataFrame.agg
    monkeypatch.setattr(DataFrame, "agg", lambda self, *parts: ran.append(agg(self, *parts)) or ran[-1])
    return ran


def test_rows_are_read_twice_at_any_number_of_columns(spark, monkeypatch):
    n = 20_000
    df = spark.range(n).select(*[F.hash(F.lit(i), "id").cast("double").alias(f"c{i}") for i in range(30)])
    ran = passes(monkeypatch)
    out = quality.profile_numeric(df, df.columns).collect()
    assert len(out) == 30 and len(ran) == 2
    for plan in (x._jdf.queryExecution().executedPlan().toString() for x in ran):
        assert "Expand" not in plan and "Generate" not in plan and "hashpartitioning" not in plan


def test_profile_of_numbers_equals_numpy(spark):
    data = drawn(3, 4000)[["wide", "ties", "mostly_one"]]
    got = {r.column: r for r in quality.profile_numeric(spark.createDataFrame(data), list(data)).collect()}
    for c in data:
        counts, _ = np.histogram(data[c], 5)
        assert got[c].hist == "|".join(map(str, counts))
        assert (got[c].n_missing, got[c].complete_rate, got[c].p50) == (0, 1.0, round(float(np.median(data[c])), 4))
        assert got[c].sd == pytest.approx(data[c].std(), abs=1e-4)


def test_summaries_without_groups_take_the_wide_passes(spark, monkeypatch):
    df = spark.createDataFrame(drawn(4, 1000))
    ran = passes(monkeypatch)
    six = {r.column: r for r in quality.six_number(df, ["wide", "ties"]).collect()}
    described = {r.variable: r for r in stats.describe_num(df, ["wide", "ties"]).collect()}
    assert len(ran) == 2  # sketches of so few rows hold them all
    for c in six:
        assert (six[c].min, six[c].q1, six[c].median, six[c].q3, six[c].max) == tuple(described[c][n] for n in ("min", "q1", "median", "q3", "max"))


def test_profile_of_texts_counts_values_without_expanding_rows(spark):
    long = "x" * 500
    df = spark.createDataFrame([("a", long), ("a", long + "y"), (None, long), ("", " "), ("b", None)], "s string, t string")
    out = quality.profile_text(df, ["s", "t"])
    rows = {r.column: r for r in out.collect()}
    assert tuple(rows["s"])[1:] == (1, 0.8, 0, 1, 1, 3, 0)
    assert tuple(rows["t"])[1:] == (1, 0.8, 1, 501, 0, 3, 1)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
