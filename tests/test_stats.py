"""Group statistics on tiny tables: ties, NULL groups, thresholds, shares."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from padronix.operators import distribution, quality, stats


def test_freq_counts_null_and_adds_up(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    rows = {r.value: (r.n, r.pct) for r in stats.freq(df, "c").collect()}
    assert rows == {"a": (2, 50.0), None: (1, 25.0), "b": (1, 25.0)}


def test_ties_stay_in_top_and_extremes(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0), ("c", 2.0), ("d", 1.0), ("e", 1.0)], "g string, m double")
    assert {r.g for r in stats.top_with_ties(df, "m", 1).collect()} == {"a", "b"}
    assert {r.g for r in stats.top_with_ties(df, "m", 4).collect()} == set("abcde")
    out = stats.extremes(df, "g", "m", F.lit(2.0)).collect()
    assert sorted((r.position, r.g) for r in out) == [("best", "a"), ("best", "b"), ("worst", "d"), ("worst", "e")]
    assert {(r.range, r.n_above, r.n_not_above) for r in out} == {(2.0, 2, 3)}
    assert [tuple(r) for r in stats.top_groups(df.withColumn("k", F.lit("x")), "k", 3).collect()] == [("x", 5)]


def test_group_profile_minimum_and_overall_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 9.0), (None, 4.0), ("a", None)], "g string, x double")
    rows = stats.group_profile(df, "g", "x", min_n=2).collect()
    assert [(r.g, r.n, r.mean, r["median"], r.deviation) for r in rows] == [("a", 2, 1.5, 1.5, -2.5)]


def test_group_size_filter_keeps_every_row_of_big_groups(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    assert stats.filter_by_group_size(df, "g", 50).count() == 90


def test_period_change_and_quotient(spark):
    df = spark.createDataFrame([("a", 2021, "s"), ("a", 2022, "s"), ("a", 2022, "t"), ("b", 2021, "s"), ("b", 2020, "t")], "r string, y int, s string")
    rows = {r.r: (r.n_before, r.n_after, r.change, r.pct_change) for r in stats.period_change(df, "r", "y", 2021, 2022).collect()}
    assert rows == {"a": (1, 2, 1, 100.0), "b": (1, 0, -1, -100.0)}
    lq = {(r.r, r.s): r.lq for r in stats.location_quotient(df, "r", "s").collect()}
    assert lq[("a", "s")] == pytest.approx((2 / 3) / (3 / 5), abs=1e-4)


def test_concentration(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] * 2, "g string")
    assert [tuple(r) for r in stats.concentration(df, "g", 2).orderBy("g").collect()] == [("a", 5, 50.0, 50.0), ("b", 3, 30.0, 80.0)]


def test_crosstab_wide_fills_empty_cells(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "g string, c string")
    assert sorted(tuple(r) for r in stats.crosstab_wide(df, "g", "c", ["x", "y"]).collect()) == [("a", 1, 0), ("b", 0, 1)]


def test_histogram_edges_and_constant_column(spark):
    rows = {r.bin: r.n for r in distribution.histogram(spark.range(11), "id", 5).collect()}
    assert rows == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert [(r.bin, r.n) for r in distribution.histogram(spark.range(5).select(F.lit(1.0).alias("x")), "x", 5).collect()] == [(0, 5)]


def test_density_integrates_to_about_one(spark):
    df = spark.range(4000).select((F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("x"))
    rows = distribution.density(df, "x").orderBy("point").collect()
    step = rows[1].x - rows[0].x
    assert len(rows) == 64 and 0.85 < sum(r.density for r in rows) * step < 1.05


def test_box_and_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 1.0)], "g string, x double")
    rows = {r.g: r for r in distribution.box_stats(df, "x", ["g"]).collect()}
    assert (rows["a"].q1, rows["a"]["median"], rows["a"].q3, rows["a"].whisker_high, rows["a"].n_outliers) == (2.25, 3.5, 4.75, 5.0, 1)
    flagged = distribution.flag_outliers(df.withColumn("x", F.when(F.col("x") != 3, F.col("x"))), "x", ["g"])
    assert flagged.count() == 7 and [r.x for r in flagged.where("is_outlier").collect()] == [100.0]


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (2, "x", float("nan"))], "a int, b string, c double")
    assert {r.column: (r.n_missing, r.pct_missing) for r in quality.missing_report(df).collect()} == {"b": (2, 66.67), "c": (1, 33.33)}
    assert tuple(quality.duplicate_count(df).first()) == (3, 2, 1, 33.33)
    text, numeric = quality.profile(df)
    assert [(r.column, r.n_missing, r.n_unique) for r in text.collect()] == [("b", 2, 1)]
    assert {r.column: (r.n_missing, r.p50, r.hist) for r in numeric.collect()}["a"] == (0, 1.0, "2|0|0|0|1")


def test_audit_of_an_empty_stage(spark):
    df = spark.range(0)
    row = quality.audit_row("s", "d", df, df).first()
    assert (row.n_before, row.n_after, row.pct_removed) == (0, 0, None) and row.logged_at is not None


def test_density_of_skewed_values_equals_a_direct_kernel_sum(spark):
    rng = random.Random(5)
    values = [min(23_097.0, 1 + 6 * math.exp(1.4 * rng.gauss(0, 1))) for _ in range(20_000)] + [1.0, 23_097.0]
    rows = distribution.density(spark.createDataFrame([(v,) for v in values], "x double"), "x", points=4000).collect()
    at = {r.point: (r.x, r.density) for r in rows}
    x = np.array(values)
    spread = min(x.std(ddof=1), (np.quantile(x, 0.75) - np.quantile(x, 0.25)) / 1.34)
    h = 0.9 * spread * len(x) ** -0.2
    for p in (0, 1, 2, 3, 10, 100, 3999):
        want = float(np.exp(-0.5 * ((at[p][0] - x) / h) ** 2).sum() / (math.sqrt(2 * math.pi) * h * len(x)))
        assert at[p][1] == pytest.approx(want, rel=0.02, abs=1e-7)
    fine = distribution.density(spark.createDataFrame([(v,) for v in values], "x double").where("x < 60"), "x", points=600).collect()
    step = (max(r.x for r in fine) - min(r.x for r in fine)) / 599
    assert sum(r.density for r in fine) * step == pytest.approx(1, abs=0.06)  # the kernel spills over the least value


def test_density_of_equal_values(spark):
    rows = distribution.density(spark.createDataFrame([(3.0,)] * 5, "x double"), "x").collect()
    assert len(rows) == 64 and all(r.density > 0 for r in rows)


def test_quality_metrics_group_by_each_column_alone(spark):
    rows = [("x", 1, 0.5, True), ("x", 2, None, False), (None, 2, 1.0, None), ("y", None, 0.0, True), ("y", None, 0.0, True)]
    df = spark.createDataFrame(rows, "a string, b int, s double, e boolean")
    out = quality.quality_metrics(df, {"as": "a", "bs": "b", "again": "a"}, "s", F.col("e"))
    assert out.first().asDict() == {
        "n_rows": 5, "as": 3, "bs": 3, "again": 3, "mean_share": 0.375, "n_events": 3, "event_rate": 75.0
    }
    assert "spark_grouping_id" in out._jdf.queryExecution().optimizedPlan().toString()  # not by their combinations
    none = quality.quality_metrics(df.limit(0), {"as": "a"}, "s", F.col("e")).first()
    assert tuple(none) == (0, 0, None, 0, None)
