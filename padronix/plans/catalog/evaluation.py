"""Evaluation queries on a fixed score of the line items, and fitted models."""

from pyspark.sql import functions as F

from padronix.operators import evaluation, stats
from padronix.plans.catalog.base import query
from padronix.plans.star import table

# Score, prediction and label of every line: a score with many distinct values and some ties.
SCORED = """SELECT l_returnflag = 'R' AS y, CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END AS label,
  l_discount * 5 + l_quantity / 100 + CASE WHEN l_returnflag = 'R' THEN 0.1 ELSE 0 END AS score,
  CASE WHEN l_discount * 5 + l_quantity / 100 > 0.6 THEN 'yes' ELSE 'no' END AS predicted FROM lineitem"""


def scored(spark, d):
    yes = F.col("l_returnflag") == "R"
    base = F.col("l_discount") * 5 + F.col("l_quantity") / 100
    return table(spark, d, "lineitem").select(
        F.when(yes, "yes").otherwise("no").alias("label"),
        (base + F.when(yes, 0.1).otherwise(0.0)).alias("score"),
        F.when(base > 0.6, "yes").otherwise("no").alias("predicted"),
    )


COUNTS = f"""SELECT count(*) FILTER (y AND predicted = 'yes')::DOUBLE AS tp, count(*) FILTER (NOT y AND predicted = 'yes')::DOUBLE AS fp,
  count(*) FILTER (y AND predicted = 'no')::DOUBLE AS fn, count(*) FILTER (NOT y AND predicted = 'no')::DOUBLE AS tn FROM ({SCORED})"""
METRICS = """round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fn), 6) AS sensitivity,
  round(tn / (tn + fp), 6) AS specificity, round(tp / (tp + fp), 6) AS precision,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy"""
CELLS = "tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn"


@query(f"SELECT {CELLS}, {METRICS} FROM ({COUNTS})")
def confusion(spark, d):
    return evaluation.confusion(scored(spark, d), "predicted", "label", "yes")


@query(f"""
WITH g AS (SELECT score, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM ({SCORED}) GROUP BY 1),
w AS (SELECT *, coalesce(sum(p) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM g)
SELECT CAST(sum(p) AS BIGINT) AS n_positive, CAST(sum(n) AS BIGINT) AS n_negative,
  round(CAST(sum(n * (above + p * 0.5)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)), 6) AS auc
FROM w
""")
def auc(spark, d):
    return evaluation.auc(scored(spark, d), "score", "label", "yes")


@query(f"""
WITH g AS (SELECT score, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM ({SCORED}) GROUP BY 1)
SELECT score AS threshold,
  round(CAST(sum(n) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(n) FROM g), 6) AS fpr,
  round(CAST(sum(p) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(p) FROM g), 6) AS tpr
FROM g
""")
def roc_points(spark, d):
    return evaluation.roc_points(scored(spark, d), "score", "label", "yes")


@query(f"""
WITH b AS (SELECT max(n) / sum(n) AS b FROM (SELECT count(*)::DOUBLE AS n FROM ({SCORED}) GROUP BY label))
SELECT {CELLS}, {METRICS}, round(b, 6) AS baseline_accuracy,
  round((round((tp + tn) / (tp + fp + fn + tn), 6) - round(b, 6)) * 100, 4) AS lift_points
FROM ({COUNTS}), b
""")
def lift(spark, d):
    rows = scored(spark, d)
    return evaluation.lift(
        evaluation.confusion(rows, "predicted", "label", "yes"), stats.baseline(rows, "label")
    )


@query(f"""
SELECT l_linestatus, accuracy, CASE WHEN accuracy >= 0.8 THEN 'high' WHEN accuracy >= 0.5 THEN 'moderate' ELSE 'hard' END AS verdict
FROM (SELECT l_linestatus, round(avg(CASE WHEN (l_discount > 0.05) = (l_returnflag = 'R') THEN 1.0 ELSE 0.0 END), 6) AS accuracy
  FROM lineitem GROUP BY 1)
""")
def verdicts(spark, d):
    right = (F.col("l_discount") > 0.05) == (F.col("l_returnflag") == "R")
    metrics = table(spark, d, "lineitem").groupBy("l_linestatus").agg(
        F.round(F.avg(right.cast("double")), 6).alias("accuracy")
    )
    return evaluation.verdicts(metrics, "accuracy", [(0.8, "high"), (0.5, "moderate")], "hard")
