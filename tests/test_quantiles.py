"""Exact quantiles against numpy, also with skewed groups and forced brackets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from padronix.operators import quantiles as module
from padronix.operators.quantiles import median, quantiles, quantiles_of

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def table(spark, groups):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "g string, v double")


def check(spark, groups, **options):
    got = {r.g: [r[f"q{i}"] for i in range(len(PROBS))] for r in quantiles(table(spark, groups), "v", PROBS, ["g"], **options).collect()}
    for g, vs in groups.items():
        np.testing.assert_allclose(got[g], np.quantile(np.array(vs), PROBS), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("accuracy", [200, 20_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_numpy(spark, accuracy, seed):
    rng = np.random.default_rng(seed)
    check(
        spark,
        {
            "hot": rng.lognormal(0, 3, 6000),
            "ties": rng.integers(0, 5, 3000),
            "mostly_one": np.r_[np.full(2500, 7.0), rng.normal(0, 1, 500)],
            "few": rng.normal(0, 1, 3),
            "one": [4.5],
        },
        accuracy=accuracy,
    )


@pytest.mark.parametrize("grouped", [True, False])
def test_brackets_are_narrowed_to_any_bound(spark, monkeypatch, grouped):
    """With a tiny bound several narrowings run, and the result stays exact."""
    calls = []
    narrowed = module._narrowed
    monkeypatch.setattr(module, "_narrowed", lambda *a: calls.append(1) or narrowed(*a))
    monkeypatch.setattr(module, "GRID", 20)
    rng = np.random.default_rng(4)
    groups = {"a": rng.lognormal(0, 3, 20_000), "b": rng.integers(0, 50, 9000), "c": [1.0, 2.0]}
    if grouped:
        check(spark, groups, accuracy=400, task_rows=20)
    else:
        got = quantiles(table(spark, {"a": groups["a"]}), "v", PROBS, accuracy=400, task_rows=20).first()
        np.testing.assert_allclose(list(got), np.quantile(groups["a"], PROBS), rtol=1e-12)
    assert len(calls) > 1


@pytest.mark.parametrize("n", range(1, 12))
def test_every_small_size(spark, n):
    check(spark, {"a": np.arange(n) * 1.5})


def test_salted_join_path(spark, no_small_tables):
    rng = np.random.default_rng(9)
    check(spark, {"hot": rng.normal(0, 1, 4000), "b": rng.normal(0, 1, 50)}, accuracy=300)


def test_missing_values_and_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), (None, 5.0), ("empty", None)], "g string, v double"
    )
    out = quantiles(df, "v", [0.5], ["g"], also={"n": F.count(F.lit(1)), "mean": F.avg(F.nanvl("v", F.lit(None)))})
    assert {r.g: (r.q0, r.n) for r in out.collect()} == {"a": (2.0, 4), None: (5.0, 1), "empty": (None, 1)}


def test_whole_table_and_several_columns(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).alias("b"))
    assert median(df, "a").first()[0] == 500.5
    out = {r.variable: (r.q0, r.q1) for r in quantiles_of(df, ["a", "b"], [0.5, 1.0]).collect()}
    assert out == {"a": (500.5, 1000.0), "b": (1001.0, 2000.0)}


def test_empty_table_gives_null(spark):
    df = spark.createDataFrame([], "v double")
    rows = quantiles(df, "v", [0.25, 0.5]).collect()
    assert [(r.q0, r.q1) for r in rows] in ([], [(None, None)])


def test_probabilities_must_be_sorted(spark):
    with pytest.raises(ValueError):
        quantiles(spark.range(3), "id", [0.5, 0.25])


def test_plan_does_not_gather_values_in_one_buffer(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    plan = median(df, "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "percentile(" not in plan and "collect_list" not in plan
