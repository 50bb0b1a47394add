"""Histograms, densities, box statistics, trends and outliers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.functions.values import equal_width_bin, pct
from padronix.operators.quantiles import quantiles
from padronix.operators.sizing import join_table


def _ranged(df: DataFrame, x: str) -> DataFrame:
    """Present values of x next to their range, the range being a one-row scalar subquery."""
    rows = df.select(F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    span = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("r")).scalar()
    return rows.withColumn("_r", span)


def histogram(df: DataFrame, x: str, bins: int, digits: int = 6) -> DataFrame:
    """Counts per equal-width bin between minimum and maximum; empty bins give no row."""
    rows = _ranged(df, x)
    binned = rows.select(equal_width_bin(F.col("_x"), F.col("_r.lo"), F.col("_r.hi"), bins).alias("bin"), "_r")
    counts = binned.groupBy("bin", "_r").agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("_r.hi") - F.col("_r.lo")) / bins
    return counts.select(
        "bin",
        F.round(F.col("_r.lo") + F.col("bin") * width, digits).alias("low"),
        F.round(F.col("_r.lo") + (F.col("bin") + 1) * width, digits).alias("high"),
        "n",
    )


BINS_PER_BANDWIDTH = 8
REACH = 6  # bandwidths beyond which a kernel is nothing


def density(df: DataFrame, x: str, points: int = 64, digits: int = 8) -> DataFrame:
    """Gaussian kernel density at evenly spaced points, from counts in bins that follow the bandwidth.

    The bandwidth is 0.9 min(sd, IQR / 1.34) n^(-1/5); where that is 0, of the sd, else of the smallest value's
    size, else of 1. An eighth of it is a bin's width, so a bin stands for its values at any skew and size; only bins
    with rows exist. A bin adds to the points within six bandwidths, in the grouped sum that ends the work.
    """
    rows = _ranged(df, x)
    quart = quantiles(df, x, [0.25, 0.75]).select((F.col("q1") - F.col("q0")).alias("iqr")).scalar()
    spread = F.least(F.col("sd"), quart / 1.34)
    for other in (F.col("sd"), F.abs("lo"), F.lit(1.0)):
        spread = F.when(F.coalesce(spread, F.lit(0.0)) > 0, spread).otherwise(other)
    moments = (
        rows.agg(F.stddev_samp("_x").alias("sd"), F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"))
        .withColumn("spread", spread)
        .select(F.struct((F.col("spread") * 0.9 * F.pow("n", F.lit(-0.2))).alias("h"), "n").alias("m"))
        .scalar()
    )
    placed = rows.withColumn("_m", moments).withColumn("_w", F.col("_m.h") / BINS_PER_BANDWIDTH)
    counts = placed.groupBy(F.floor((F.col("_x") - F.col("_r.lo")) / F.col("_w")).alias("bin"), "_r", "_m", "_w").agg(
        F.count(F.lit(1)).alias("c")
    )
    step = (F.col("_r.hi") - F.col("_r.lo")) / (points - 1)
    center = (F.col("bin") + 0.5) * F.col("_w")
    # all values equal: every point lies on the one bin
    first = F.when(step > 0, F.greatest(F.ceil((center - REACH * F.col("_m.h")) / step), F.lit(0))).otherwise(0)
    last = F.when(step > 0, F.least(F.floor((center + REACH * F.col("_m.h")) / step), F.lit(points - 1))).otherwise(points - 1)
    near = counts.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    grid = near.withColumn("point", F.explode(F.sequence("_first", "_last")))
    z = (step * F.col("point") - center) / F.col("_m.h")
    weight = F.col("c") * F.exp(-0.5 * z * z) / (math.sqrt(2 * math.pi) * F.col("_m.h") * F.col("_m.n"))
    sums = grid.groupBy(F.col("point").cast("int").alias("point")).agg(F.sum(weight).alias("density"))
    span = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("r")).scalar()
    at = F.col("_s.lo") + (F.col("_s.hi") - F.col("_s.lo")) * F.col("point") / (points - 1)
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point")).withColumn("_s", span).where("_s.lo IS NOT NULL")
    return every.join(sums, "point", "left").select(
        "point", F.round(at, 6).alias("x"), F.round(F.coalesce("density", F.lit(0.0)), digits).alias("density")
    )


def box_stats(df: DataFrame, x: str, by: Sequence[str], digits: int = 4) -> DataFrame:
    """Per group: quartiles, the extremes within 1.5 IQR of the box, and the rows outside."""
    by = list(by)
    rows = df.select(*by, F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    marks = quantiles(rows, "_x", [0.25, 0.5, 0.75], by)
    reach = 1.5 * (F.col("q2") - F.col("q0"))
    fenced = join_table(rows, marks.withColumns({"_lo": F.col("q0") - reach, "_hi": F.col("q2") + reach}), by)
    inside = F.col("_x").between(F.col("_lo"), F.col("_hi"))
    return fenced.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.first("q0"), digits).alias("q1"),
        F.round(F.first("q1"), digits).alias("median"),
        F.round(F.first("q2"), digits).alias("q3"),
        F.round(F.min(F.when(inside, F.col("_x"))), digits).alias("whisker_low"),
        F.round(F.max(F.when(inside, F.col("_x"))), digits).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def flag_outliers(df: DataFrame, x: str, by: Sequence[str], name: str = "is_outlier", reach: float = 1.5) -> DataFrame:
    """Every row, flagged when x lies more than `reach` IQR outside its group's quartiles."""
    by = list(by)
    fence = quantiles(df, x, [0.25, 0.75], by).select(
        *by,
        (F.col("q0") - reach * (F.col("q1") - F.col("q0"))).alias("_lo"),
        (F.col("q1") + reach * (F.col("q1") - F.col("q0"))).alias("_hi"),
    )
    flag = F.coalesce(~F.col(x).between(F.col("_lo"), F.col("_hi")), F.lit(False))
    return join_table(df, fence, by, "left").withColumn(name, flag).drop("_lo", "_hi")


def outlier_counts(df: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    """Outliers and their share per group."""
    flagged = flag_outliers(df.where(F.col(x).isNotNull()).select(*by, x), x, by)
    out = flagged.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("n_outliers"))
    return out.withColumn("pct_outliers", pct(F.col("n_outliers"), F.col("n"), 4))


def binned_trend(df: DataFrame, x: str, y: str, bins: int, digits: int = 4) -> DataFrame:
    """Mean of y per equal-width bin of x, with sd and a 95 % normal band."""
    rows = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).na.drop()
    span = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("r")).scalar()
    rows = rows.withColumn("_r", span)
    bin_id = equal_width_bin(F.col("_x"), F.col("_r.lo"), F.col("_r.hi"), bins)
    stats = rows.groupBy(bin_id.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_x").alias("x"),
        F.avg("_y").alias("mean"),
        F.stddev_samp("_y").alias("sd"),
    )
    half = 1.96 * F.col("sd") / F.sqrt("n")
    return stats.select(
        "bin",
        "n",
        F.round("x", digits).alias("mean_x"),
        F.round("mean", digits).alias("mean_y"),
        F.round("sd", digits).alias("sd_y"),
        F.round(F.col("mean") - half, digits).alias("low"),
        F.round(F.col("mean") + half, digits).alias("high"),
    )
