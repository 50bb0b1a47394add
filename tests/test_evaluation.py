"""Metrics against brute force, and the tables built from them."""

import random

import pytest
from pyspark.sql import functions as F

from padronix.operators import evaluation, stats


def brute_auc(rows):
    pos = [s for s, y in rows if y == "p"]
    neg = [s for s, y in rows if y != "p"]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [1, 4, 64])
@pytest.mark.parametrize("digits", [1, 6])
def test_auc_matches_all_pairs(spark, ranges, digits):
    rng = random.Random(digits)
    # a third of the rows share one score
    rows = [(0.5 if i % 3 == 0 else round(rng.random(), digits), rng.choice("pn")) for i in range(600)]
    df = spark.createDataFrame(rows, "s double, y string")
    got = evaluation.auc(df, "s", "y", "p", digits=12, ranges=ranges).first()
    assert got.auc == pytest.approx(brute_auc(rows), abs=1e-10)
    flipped = evaluation.auc(df.withColumn("s", -F.col("s")), "s", "y", "p", digits=12, ranges=ranges).first()
    assert got.auc + flipped.auc == pytest.approx(1.0)


def test_auc_by_the_shuffle_path(spark, no_small_tables):
    rows = [(i / 50, "p" if i % 3 else "n") for i in range(50)]
    df = spark.createDataFrame(rows, "s double, y string")
    assert evaluation.auc(df, "s", "y", "p", 12, 8).first().auc == pytest.approx(brute_auc(rows))


def test_roc_is_monotone_and_ends_at_one(spark):
    df = spark.range(500).select((F.xxhash64("id") % 97 / 97.0).alias("s"), F.when(F.col("id") % 4 == 0, "p").otherwise("n").alias("y"))
    full = evaluation.roc_points(df, "s", "y", "p").orderBy(F.desc("threshold")).collect()
    assert full[-1].fpr == full[-1].tpr == 1.0
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(full, full[1:]))
    few = evaluation.roc_points(df, "s", "y", "p", max_points=10).collect()
    assert len(few) <= 11 and {(r.fpr, r.tpr) for r in few} <= {(r.fpr, r.tpr) for r in full}


def test_confusion(spark):
    rows = [("y", "y")] * 3 + [("y", "n")] * 1 + [("n", "y")] * 2 + [("n", "n")] * 4 + [(None, "y")]
    out = evaluation.confusion(spark.createDataFrame(rows, "p string, l string"), "p", "l", "y").first()
    assert (out.tp, out.fp, out.fn, out.tn) == (3, 1, 2, 4)
    assert (out.accuracy, out.sensitivity, out.specificity, out.precision) == (0.7, 0.6, 0.8, 0.75)
    assert out.f1 == pytest.approx(2 * 0.75 * 0.6 / 1.35, abs=1e-6) and out.balanced_accuracy == 0.7


@pytest.mark.parametrize(
    ("accuracy", "sensitivity", "specificity"),
    # The published metrics of the two compared models
    [(0.642072, 0.435987, 0.762098), (0.67126, 0.12402, 0.98998)],
)
def test_published_metrics_are_consistent(accuracy, sensitivity, specificity):
    prevalence = 0.3681
    assert sensitivity * prevalence + specificity * (1 - prevalence) == pytest.approx(accuracy, abs=2e-4)


def test_coefficients_and_significant_terms(spark):
    terms = [("(Intercept)", 3.0, 0.1, 30.0, 0.0), ("a", -0.5, 0.1, -5.0, 0.0001), ("b", 0.2, 0.1, 2.0, 0.04), ("c", 0.1, 0.1, 1.0, 0.3)]
    coefs = evaluation.coef_table(spark, terms)
    assert [(r.term, r.stars) for r in coefs.collect()] == [("(Intercept)", "***"), ("a", "***"), ("b", "*"), ("c", "")]
    out = {r.term: (r.direction, r.pct_change) for r in evaluation.significant_terms(coefs).collect()}
    assert out == {"a": ("decreases", 39.3), "b": ("increases", 22.1)}


def test_verdicts_lift_and_summary(spark):
    metrics = spark.createDataFrame([("A_1", 0.85, 0.9), ("B_2", 0.65, 0.7), ("C", 0.5, 0.6)], "model string, accuracy double, auc double")
    rules = [(0.8, "high"), (0.6, "moderate")]
    assert {r.model: r.verdict for r in evaluation.verdicts(metrics, "accuracy", rules, "hard").collect()} == {
        "A_1": "high", "B_2": "moderate", "C": "hard",
    }
    data = spark.createDataFrame([("y",)] * 6 + [("n",)] * 4, "l string")
    base = stats.baseline(data, "l")
    assert tuple(base.first()) == ("y", 0.6)
    assert {r.model: r.lift_points for r in evaluation.lift(metrics, base).collect()}["A_1"] == 25.0
    ranked = evaluation.compare_models(metrics)
    assert [r.model for r in ranked.collect()] == ["A 1", "B 2", "C"]
    out = {r.metric: r.value for r in evaluation.classification_summary(data, ranked.limit(1), base).collect()}
    assert out == {
        "observations": "10", "baseline_accuracy": "60.00%", "best_model": "A 1", "best_auc": "0.9000",
        "gain_over_baseline": "25.00 pp",
    }


def test_permutation_importance_finds_the_used_column(spark):
    df = spark.range(2000).select(
        F.col("id"), (F.xxhash64("id") % 2 == 0).cast("int").alias("used"), (F.xxhash64("id", F.lit(1)) % 5).cast("int").alias("noise")
    ).withColumn("label", F.col("used").cast("string"))

    def score(d):
        return d.withColumn("predicted", F.col("used").cast("string"))

    def accuracy(d):
        return evaluation.confusion(d, "predicted", "label", "1").first().accuracy

    out = evaluation.permutation_importance(df, ["used", "noise"], score, accuracy, 42, ["id"], rows_per_bucket=300)
    rows = {r.variable: r for r in out.collect()}
    assert rows["used"].importance == 100 and rows["used"].raw == pytest.approx(0.5, abs=0.06)
    assert rows["noise"].importance == 0 and rows["noise"].raw == 0
