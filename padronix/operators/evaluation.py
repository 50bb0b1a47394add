"""Evaluation of classifiers and their coefficient, importance and verdict tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padronix.functions.text import row_hash
from padronix.operators.sizing import join_table

RANGE_SCORES = 1_000_000  # distinct scores that one task orders


def confusion(df: DataFrame, pred: str, label: str, positive, digits: int = 6) -> DataFrame:
    """Confusion counts and the metrics of the named positive class, in one aggregate."""
    said, real = F.col(pred) == F.lit(positive), F.col(label) == F.lit(positive)
    counts = df.where(F.col(pred).isNotNull() & F.col(label).isNotNull()).agg(
        F.count_if(said & real).alias("tp"),
        F.count_if(said & ~real).alias("fp"),
        F.count_if(~said & real).alias("fn"),
        F.count_if(~said & ~real).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    sens, spec = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    metrics = {
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
        "sensitivity": sens,
        "specificity": spec,
        "precision": F.try_divide(tp, tp + fp),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": (sens + spec) / 2,
    }
    return counts.select("tp", "fp", "fn", "tn", *[F.round(m, digits).alias(n) for n, m in metrics.items()])


def _score_counts(df: DataFrame, score: str, label: str, positive) -> DataFrame:
    """Positives and negatives per distinct score."""
    rows = df.select(F.col(score).cast("double").alias("s"), (F.col(label) == F.lit(positive)).alias("y")).na.drop()
    return rows.groupBy("s").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))


def _edges(counts: DataFrame, ranges: int) -> list[float]:
    """Score boundaries that cut distinct scores into about equal ranges: one per RANGE_SCORES of them."""
    if ranges < 2:
        return [float("-inf"), float("inf")]
    marks = counts.approxQuantile("s", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    return [float("-inf"), *sorted(set(marks)), float("inf")]


def _ranges(counts: DataFrame) -> int:
    return -(-counts.count() // RANGE_SCORES)


def running_counts(counts: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Positives and negatives at scores above each score, without one task seeing every score.

    Scores fall into ranges; totals of the ranges above come from a table of at most len(edges) rows,
    the rest from a window inside the range.
    """
    if len(edges) > 2:
        ranged = Bucketizer(splits=list(edges), inputCol="s", outputCol="range").transform(counts)
    else:
        ranged = counts.withColumn("range", F.lit(0.0))
    sums = ranged.groupBy("range").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)  # len(edges) rows only
    base = sums.select(
        "range",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("_neg"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    placed = join_table(ranged, base, ["range"])
    return placed.select(
        "s",
        "pos",
        "neg",
        (F.col("_pos") + F.coalesce(F.sum("pos").over(inside), F.lit(0))).alias("pos_above"),
        (F.col("_neg") + F.coalesce(F.sum("neg").over(inside), F.lit(0))).alias("neg_above"),
    )


def auc(df: DataFrame, score: str, label: str, positive, digits: int = 6, ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve; a higher score speaks for the positive class, ties count half.

    Runs when called: rows are grouped by score once, the groups are kept while they are ranked, and one row is returned.
    """
    counts = _score_counts(df, score, label, positive).persist()
    try:
        run = running_counts(counts, _edges(counts, ranges or _ranges(counts)))
        wins = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") * 0.5))
        pairs = F.sum("pos").cast("double") * F.sum("neg")
        row = run.agg(
            F.sum("pos").alias("n_positive"),
            F.sum("neg").alias("n_negative"),
            F.round(F.try_divide(wins, pairs), digits).alias("auc"),
        )
        return df.sparkSession.createDataFrame(row.toArrow(), schema=row.schema)
    finally:
        counts.unpersist()


def roc_points(
    df: DataFrame, score: str, label: str, positive, max_points: int | None = None, digits: int = 6
) -> DataFrame:
    """ROC points (threshold, fpr, tpr), one per distinct score or at most `max_points` of them."""
    counts = _score_counts(df, score, label, positive)
    if max_points:
        rows = df.select(F.col(score).cast("double").alias("s"))
        edges = _edges(rows, max_points)
        if len(edges) > 2:
            ranged = Bucketizer(splits=edges, inputCol="s", outputCol="range").transform(counts)
            counts = ranged.groupBy("range").agg(
                F.min("s").alias("s"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
            )
            counts = counts.drop("range")
    else:
        edges = _edges(counts, _ranges(counts))
    run = running_counts(counts, edges)
    total = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
    return run.withColumn("_t", total).select(
        F.col("s").alias("threshold"),
        F.round(F.try_divide(F.col("neg_above") + F.col("neg"), F.col("_t.n")), digits).alias("fpr"),
        F.round(F.try_divide(F.col("pos_above") + F.col("pos"), F.col("_t.p")), digits).alias("tpr"),
    )


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def coef_table(spark, terms: Sequence[tuple[str, float, float, float, float]], digits: int | None = 4) -> DataFrame:
    """Coefficient table, largest magnitude first. Terms are (name, estimate, se, z, p); digits None rounds nothing."""
    rows = spark.createDataFrame(list(terms), "term string, estimate double, std_error double, z double, p double")

    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    return rows.orderBy(F.desc(F.abs("estimate"))).select(
        "term",
        *[shown(F.col(c)).alias(c) for c in ("estimate", "std_error", "z", "p")],
        shown(F.exp("estimate")).alias("odds_ratio"),
        stars(F.col("p")).alias("stars"),
    )


def significant_terms(
    coefs: DataFrame, level: float = 0.05, intercept: str = "(Intercept)", digits: int = 4
) -> DataFrame:
    """Terms with p below the level, their direction and percentage change of the odds.

    `coefs` is an unrounded table: terms are chosen by p itself, and numbers are rounded at the end.
    """
    kept = coefs.where((F.col("p") < level) & (F.col("term") != intercept))
    return kept.select(
        "term",
        F.when(F.col("estimate") > 0, "increases").otherwise("decreases").alias("direction"),
        F.round(F.abs((F.col("odds_ratio") - 1) * 100), 1).alias("pct_change"),
        F.round("odds_ratio", digits).alias("odds_ratio"),
        F.round("p", digits).alias("p"),
    )


def scaled_importance(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Importance rescaled to 0..100 over the variables."""
    span = raw.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("s")).scalar()
    scaled = F.try_divide((F.col(column) - F.col("_s.lo")) * 100, F.col("_s.hi") - F.col("_s.lo"))
    out = raw.withColumn("_s", span).select("variable", F.round(column, 6).alias("raw"), F.round(scaled, 2).alias("importance"))
    return out.orderBy(F.desc("importance"), "variable")


def permutation_importance(
    df: DataFrame,
    cols: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    metric: Callable[[DataFrame], float],
    seed: int,
    key: Sequence[str],
    rows_per_bucket: int = 200_000,
) -> DataFrame:
    """Loss of the metric when one column's values are shuffled among rows.

    Rows are put into random buckets of bounded size and each takes the values of the row before it in a
    random order (the first row those of the last): one shuffle serves every column. `score` adds
    predictions to a table, `metric` reduces a scored table to a number.
    """
    base = metric(score(df))
    n = df.count()
    buckets = max(1, -(-n // rows_per_bucket))
    hashed = df.withColumn("_h", row_hash(seed, *key))
    bucketed = hashed.withColumn("_b", F.pmod(F.xxhash64("_h"), F.lit(buckets)))
    donor = F.struct(*[F.col(c) for c in cols])
    order = Window.partitionBy("_b").orderBy("_h")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mixed = bucketed.withColumn("_d", F.coalesce(F.lag(donor).over(order), F.last(donor).over(whole))).persist()
    try:
        drops = [(c, base - metric(score(mixed.withColumn(c, F.col(f"_d.{c}"))))) for c in cols]
    finally:
        mixed.unpersist()
    return scaled_importance(df.sparkSession.createDataFrame(drops, "variable string, raw double"))


def compare_models(results: DataFrame) -> DataFrame:
    """Metrics rows of several models, best AUC first, underscores in names shown as spaces."""
    return results.withColumn("model", F.replace("model", F.lit("_"), F.lit(" "))).orderBy(F.desc("auc"), "model")


def lift(metrics: DataFrame, base: DataFrame) -> DataFrame:
    """Accuracy points gained over the majority-class baseline."""
    accuracy = base.select("baseline_accuracy").scalar()
    return metrics.withColumn("baseline_accuracy", accuracy).withColumn(
        "lift_points", F.round((F.col("accuracy") - F.col("baseline_accuracy")) * 100, 4)
    )


def verdicts(metrics: DataFrame, metric: str, rules: Sequence[tuple[float, str]], otherwise: str) -> DataFrame:
    """First verdict whose threshold the metric reaches; rules go from high to low."""
    out = None
    for at_least, verdict in rules:
        out = F.when(F.col(metric) >= at_least, verdict) if out is None else out.when(F.col(metric) >= at_least, verdict)
    return metrics.withColumn("verdict", out.otherwise(otherwise))


def classification_summary(df: DataFrame, best: DataFrame, base: DataFrame) -> DataFrame:
    """Run summary as (metric, value) text from the best model's row and the baseline row."""
    row = df.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {
            "b": base.select("baseline_accuracy").scalar(),
            "m": best.select(F.struct("model", "auc", "accuracy")).scalar(),
        }
    )
    values: Mapping[str, Column] = {
        "observations": F.format_number("n", 0),
        "baseline_accuracy": F.format_string("%.2f%%", F.col("b") * 100),
        "best_model": F.col("m.model"),
        "best_auc": F.format_string("%.4f", F.col("m.auc")),
        "gain_over_baseline": F.format_string("%.2f pp", (F.col("m.accuracy") - F.col("b")) * 100),
    }
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()])))
