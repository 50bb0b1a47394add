"""Counts, group profiles, rates and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padronix.functions.text import shorten
from padronix.functions.values import pct
from padronix.operators.quality import distinct_counts, n_distinct
from padronix.operators.quantiles import quantiles, quantiles_of
from padronix.operators.sizing import join_table
from padronix.operators.wide_quantiles import wide_quantiles


def freq(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Count and percentage per value. The total comes from the grouped rows, not from a global window."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("pct", pct(F.col("n"), total, digits))


def crosstab(df: DataFrame, a: str, b: str, digits: int = 2) -> DataFrame:
    """Two-way counts with row percentages, long form."""
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    row_total = F.sum("n").over(Window.partitionBy(a))
    return counts.withColumn("row_pct", pct(F.col("n"), row_total, digits))


def crosstab_wide(df: DataFrame, a: str, b: str, levels: Sequence[str]) -> DataFrame:
    """Two-way counts with one column per level of `b`."""
    return df.groupBy(a).pivot(b, list(levels)).count().na.fill(0)


def composition(df: DataFrame, group: str, category: str, digits: int = 4) -> DataFrame:
    """Share of each category within its group, adding up to 1."""
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("share", F.round(F.col("n") / total, digits))


def describe_num(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Mean, median, sd, quartiles and extremes per column (and group), skipping NULL."""
    by, moments = list(by), {"mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    if by:
        out = quantiles_of(df, cols, [0.25, 0.5, 0.75], by, also={name: make("value") for name, make in moments.items()})
    else:
        out = wide_quantiles(df, cols, [0.25, 0.5, 0.75], moments)
    order = {"mean": "mean", "median": "q1", "sd": "sd", "q1": "q0", "q3": "q2", "min": "min", "max": "max"}
    return out.select("variable", *by, *[F.round(c, digits).alias(name) for name, c in order.items()])


def top_groups(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values; ties go to the smaller value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(n)


def top_with_ties(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows whose value is among the n largest; ties at the edge all stay."""
    edge = df.select(col).orderBy(F.desc_nulls_last(col)).limit(n).agg(F.min(col).alias("m")).scalar()
    return df.where(F.col(col) >= edge)


def profile_groups(df: DataFrame, by: str, metrics: Mapping[str, Column], keep: DataFrame | None = None) -> DataFrame:
    """Aggregates per group, for the groups listed in `keep` only when it is given."""
    if keep is not None:
        df = join_table(df, keep.select(by).distinct(), [by], "left_semi")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[m.alias(name) for name, m in metrics.items()])


def group_profile(df: DataFrame, by: str, x: str, min_n: int, label_width: int = 35, digits: int = 6) -> DataFrame:
    """Mean, median, sd of x per group of at least `min_n` rows, and the deviation from the overall mean."""
    moments = {"n": F.count(x), "mean": F.avg(x), "sd": F.stddev_samp(x)}
    mean = F.sum(F.col("mean") * F.col("n")) / F.sum("n")
    groups = quantiles(df.select(by, x), x, [0.5], [by], also=moments, overall={"overall": mean})
    return groups.where((F.col("n") >= min_n) & F.col(by).isNotNull()).select(
        by,
        "n",
        F.round("mean", digits).alias("mean"),
        F.round("q0", digits).alias("median"),
        F.round("sd", digits).alias("sd"),
        F.round(F.col("mean") - F.col("overall"), digits).alias("deviation"),
        shorten(F.col(by), label_width).alias("label"),
    )


def filter_by_group_size(df: DataFrame, by: str, min_n: int) -> DataFrame:
    """Rows of groups with at least `min_n` rows: a semi-join on counted keys, so rows do not move."""
    big = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_n).select(by)
    return join_table(df, big, [by], "left_semi")


def extremes(groups: DataFrame, name: str, metric: str, reference: Column, digits: int = 6) -> DataFrame:
    """Best and worst groups (ties kept), the range, and how many lie above or not above a reference."""
    summary = groups.withColumn("_ref", reference).agg(
        F.struct(
            F.max(metric).alias("hi"),
            F.min(metric).alias("lo"),
            F.count_if(F.col(metric) > F.col("_ref")).alias("above"),
            F.count_if(F.col(metric) <= F.col("_ref")).alias("below"),
        ).alias("s")
    )
    tagged = groups.withColumn("_s", summary.scalar())
    edge = tagged.where((F.col(metric) == F.col("_s.hi")) | (F.col(metric) == F.col("_s.lo")))
    return edge.select(
        F.when(F.col(metric) == F.col("_s.hi"), "best").otherwise("worst").alias("position"),
        name,
        F.round(metric, digits).alias(metric),
        F.round(F.col("_s.hi") - F.col("_s.lo"), digits).alias("range"),
        F.col("_s.above").alias("n_above"),
        F.col("_s.below").alias("n_not_above"),
    )


def area_profile(
    df: DataFrame, keys: Sequence[str], share: str, sector: str, exported: Column, small: Column, min_n: int
) -> DataFrame:
    """Per area: size, mean share, sector diversity, exporter rate and small-unit share."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(share).alias("mean_share"),
            n_distinct(sector).alias("sectors"),
            F.avg(exported.cast("double")).alias("export_rate"),
            F.avg(small.cast("double")).alias("small_share"),
        )
        .where(F.col("n") >= min_n)
    )


def area_rollup(areas: DataFrame, by: str, digits: int = 3) -> DataFrame:
    """Unweighted mean of the area means per higher unit."""
    return areas.groupBy(by).agg(
        F.round(F.avg("mean_share"), digits).alias("mean_share"), F.count(F.lit(1)).alias("areas")
    )


def rate_by(df: DataFrame, by: Sequence[str], event: Column, min_n: int = 0, digits: int = 2) -> DataFrame:
    """Event count and percentage per combination, for combinations with more than `min_n` rows."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(event).alias("events"))
    return out.where(F.col("n") > min_n).withColumn("rate", pct(F.col("events"), F.col("n"), digits))


def compare_groups(df: DataFrame, by: str, share: str, size: str, event: Column) -> DataFrame:
    """Side-by-side means of a few groups."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(share), 3).alias("mean_share"),
        F.round(F.avg(size), 1).alias("mean_size"),
        F.round(F.avg(event.cast("double")) * 100, 2).alias("event_rate"),
    )


def conditional_rates(df: DataFrame, event: Column, conditions: Mapping[str, Column], digits: int = 4) -> DataFrame:
    """P(event | condition) for several conditions in one pass."""
    items = [
        F.struct(
            F.lit(name).alias("condition"),
            F.count_if(c).alias("n"),
            F.round(F.avg(F.when(c, event.cast("double"))), digits).alias("rate"),
        )
        for name, c in conditions.items()
    ]
    return df.agg(F.array(*items).alias("_i")).select(F.inline("_i"))


def executive_summary(
    df: DataFrame, distinct: Mapping[str, str], share: str, event: Column, size: str
) -> DataFrame:
    """One row: size, distinct counts, mean and median share, event percentage, mean size."""
    row = quantiles(
        df,
        share,
        [0.5],
        also={
            "n_rows": F.count(F.lit(1)),
            "mean_share": F.round(F.avg(share), 3),
            "event_rate": F.round(F.avg(event.cast("double")) * 100, 2),
            "mean_size": F.round(F.avg(size), 1),
        },
    )
    counts = distinct_counts(df, distinct).select(F.struct(*distinct).alias("c")).scalar()
    row = row.withColumn("_c", counts).withColumn("median_share", F.round("q0", 3))
    rest = [c for c in row.columns if c not in ("n_rows", "_c", "q0")]
    return row.select("n_rows", *[F.col(f"_c.{name}").alias(name) for name in distinct], *rest)


def most_frequent(df: DataFrame, col: str, n: Column) -> Column:
    """The value with the largest total of `n` (ties: the smaller), as a scalar subquery."""
    totals = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.sum(n).alias("n"))
    return totals.orderBy(F.desc("n"), col).limit(1).select(F.col(col).cast("string")).scalar()


def insights(df: DataFrame, region: str, sector: str, share: str, event: Column) -> DataFrame:
    """Key figures as (metric, value) text, the thousands set off by dots.

    All of them are read off one table of counts and sums per (region, sector).
    """
    cells = df.groupBy(region, sector).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(share).alias("s"),
        F.count(share).alias("ns"),
        F.count_if(event).alias("e"),
        F.count(event).alias("ne"),
    )
    one = cells.agg(
        F.sum("n").alias("n"),
        (F.sum("s") / F.sum("ns") * 100).alias("s"),
        (F.sum("e") / F.sum("ne") * 100).alias("e"),
    ).withColumns({"r": most_frequent(cells, region, F.col("n")), "t": most_frequent(cells, sector, F.col("n"))})
    values = {
        "rows": F.translate(F.format_number("n", 0), ",", "."),
        "most_common_region": F.col("r"),
        "mean_share": F.concat(F.format_number("s", 1), F.lit("%")),
        "event_rate": F.concat(F.format_number("e", 1), F.lit("%")),
        "most_common_sector": F.col("t"),
    }
    items = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()]
    return one.select(F.inline(F.array(*items)))


def baseline(df: DataFrame, label: str, digits: int = 6) -> DataFrame:
    """Accuracy of always answering the majority class (ties: the larger label)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.max_by("label", F.struct("n", "label")).alias("majority"),
        F.round(F.max("n") / F.sum("n"), digits).alias("baseline_accuracy"),
    )


def concentration(df: DataFrame, by: str, n: int, digits: int = 2) -> DataFrame:
    """The n largest groups with their share and the cumulative share of all rows."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    head = counts.withColumn("_t", total).orderBy(F.desc("n"), by).limit(n)
    running = Window.orderBy(F.desc("n"), by).rowsBetween(Window.unboundedPreceding, 0)  # n rows only
    return head.select(
        by,
        "n",
        pct(F.col("n"), F.col("_t"), digits).alias("pct"),
        pct(F.sum("n").over(running), F.col("_t"), digits).alias("cum_pct"),
    )


def period_change(df: DataFrame, by: str, period: str, before, after) -> DataFrame:
    """Counts in two periods, their difference and percentage change."""
    old = F.count_if(F.col(period) == before).alias("n_before")
    new = F.count_if(F.col(period) == after).alias("n_after")
    out = df.where(F.col(period).isin(before, after)).groupBy(by).agg(old, new)
    change = F.col("n_after") - F.col("n_before")
    return out.withColumns({"change": change, "pct_change": pct(change, F.col("n_before"))})


def gap_grid(df: DataFrame, row: str, column: str, x: str, digits: int = 6) -> DataFrame:
    """Mean of x per cell and its gap from the mean of the row's rows."""
    cells = df.groupBy(row, column).agg(F.sum(x).alias("_s"), F.count(x).alias("_c"))
    over = Window.partitionBy(row)
    row_mean = F.sum("_s").over(over) / F.sum("_c").over(over)
    mean = F.col("_s") / F.col("_c")
    return cells.select(
        row, column, F.round(mean, digits).alias("mean"), F.round(mean - row_mean, digits).alias("gap")
    )


def location_quotient(df: DataFrame, region: str, sector: str, digits: int = 4) -> DataFrame:
    """Sector share within the region over the sector's share of everything."""
    cells = df.groupBy(region, sector).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").alias("t")).scalar()
    in_region = F.sum("n").over(Window.partitionBy(region))
    in_sector = F.sum("n").over(Window.partitionBy(sector))
    sized = cells.select(region, sector, "n", in_region.alias("_r")).withColumn("_s", in_sector)
    lq = (F.col("n") / F.col("_r")) / (F.col("_s") / total)
    return sized.select(region, sector, "n", F.round(lq, digits).alias("lq"))


def grid_cells(df: DataFrame, lat: str, lon: str, step_lat: float, step_lon: float, digits: int = 4) -> DataFrame:
    """Counts and centroid per cell of a regular grid: the data behind a clustered point map."""
    have = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return have.groupBy(
        F.floor(F.col(lat) / step_lat).alias("cell_lat"), F.floor(F.col(lon) / step_lon).alias("cell_lon")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(lat), digits).alias("center_lat"),
        F.round(F.avg(lon), digits).alias("center_lon"),
    )


def metric_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A one-row table as (metric, value) text rows."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "metric", "value")


