"""Exact quantiles (linear interpolation) without one task ever holding a group's values.

`percentile` keeps every distinct value of a group in one buffer. Here a mergeable sketch first brackets
each wanted rank. Brackets that may hold more than `task_rows` rows are narrowed by further sketches of what
lies inside them, each to about 1 / 200. A last pass counts rows, keeping single values only inside the brackets
and collapsing all others into one count per gap. Groups of fewer than `accuracy` rows are bracketed whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padronix.operators.sizing import join_table, pin_small

ACCURACY = 20_000
TASK_ROWS = 2_000_000  # rows in a bracket up to which one task orders them
GRID = 1_000  # marks that cut a bracket when it is narrowed


def _interpolated(probs: Sequence[float], prefix: str) -> list[Column]:
    """Per quantile, pick the values at the two neighbouring ranks and interpolate."""
    first, last = F.col("_cum") - F.col("_cnt"), F.col("_cum") - 1
    out = []
    for i, p in enumerate(probs):
        position = (F.max("_n") - 1) * F.lit(float(p))
        rank = (F.col("_n") - 1) * F.lit(float(p))
        at_floor = F.max(F.when(F.floor(rank).between(first, last), F.col("_key")))
        at_ceil = F.max(F.when(F.ceil(rank).between(first, last), F.col("_key")))
        value = at_floor + (at_ceil - at_floor) * (position - F.floor(position))
        guard = F.raise_error(F.lit("quantile rank outside its sketch bracket; raise accuracy"))
        missed = F.max("_n").isNotNull() & (at_floor.isNull() | at_ceil.isNull())
        out.append(F.when(missed, guard.cast("double")).otherwise(value).alias(f"{prefix}{i}"))
    return out


def _number(x: float | None) -> Column:
    return F.lit(x).cast("double")


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    also: Mapping[str, Column] | None = None,
    overall: Mapping[str, Column] | None = None,
    prefix: str = "q",
    accuracy: int = ACCURACY,
    task_rows: int | None = None,
) -> DataFrame:
    """One row per group with columns q0, q1, ... for the sorted `probs`; NULL and NaN are skipped.

    `also` names aggregates over all rows of the group, computed in the sketch's pass; `overall` aggregates
    those of all groups into one number, put beside every group. A group without any value has NULL
    quantiles. The sketch passes run when this is called.
    """
    if list(probs) != sorted(set(probs)):
        raise ValueError("probs must be sorted and distinct")
    by, also, k = list(by), dict(also or {}), len(probs)
    number = F.col(value).cast("double")
    v = F.when(~F.isnan(number), number)
    # the sketch may miss by n / accuracy ranks, and interpolation needs one rank more on either side
    margin = 3.5 / accuracy
    edges = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
    sketch = df.groupBy(*by).agg(
        F.count(v).alias("_n"),
        F.percentile_approx(v, edges, accuracy).alias("_e"),
        F.min(v).alias("_min"),
        F.max(v).alias("_max"),
        *[c.alias(name) for name, c in also.items()],
    )
    local = pin_small(sketch)
    groups = sketch.persist() if local is None else local
    rows = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull())
    whole = F.col("_n") < accuracy
    lows = [F.when(whole | (edges[i] == 0.0), F.col("_min")).otherwise(F.col("_e")[i]) for i in range(k)]
    highs = [F.when(whole | (edges[k + i] == 1.0), F.col("_max")).otherwise(F.col("_e")[k + i]) for i in range(k)]
    kept = groups
    groups = groups.select("*", F.array(*lows).alias("_lo"), F.array(*highs).alias("_hi"))
    limit = task_rows or TASK_ROWS
    held = (groups.agg(F.max("_n")).first()[0] or 0) * 2 * margin
    while held > limit:
        groups = _narrowed(rows, groups, by, probs, accuracy, local is not None)
        held = held * 6 / GRID
    if by:
        tagged = join_table(rows, groups.select(*by, "_n", "_lo", "_hi"), by, small=local is not None)
        lows, highs = ([F.col(c)[i] for i in range(k)] for c in ("_lo", "_hi"))
    else:
        one = groups.first()  # a handful of numbers
        tagged = rows.withColumn("_n", F.lit(one["_n"]).cast("long"))
        lows, highs = ([_number(x) for x in one[c]] for c in ("_lo", "_hi"))
    opened = reduce(lambda a, b: a + b, [(F.col("_v") >= edge).cast("int") for edge in lows])
    closed = reduce(lambda a, b: a + b, [(F.col("_v") > edge).cast("int") for edge in highs])
    counted = (
        tagged.select(*by, "_n", "_v", opened.alias("_open"), closed.alias("_shut"))
        .select(
            *by,
            "_n",
            (F.col("_open") + F.col("_shut")).alias("_gap"),
            F.when(F.col("_open") > F.col("_shut"), F.col("_v")).alias("_key"),
        )
        .groupBy(*by, "_n", "_gap", "_key")
        .agg(F.count(F.lit(1)).alias("_cnt"))
    )
    order = Window.partitionBy(*by).orderBy("_gap", "_key").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_cum", F.sum("_cnt").over(order))
    picked = ranked.groupBy(*by).agg(*_interpolated(probs, prefix))
    if by:
        out = join_table(groups.select(*by, *also), picked, by, "left", small=local is not None)
        totals = kept.agg(*[c.alias(name) for name, c in (overall or {}).items()]).first() if overall else {}
        return out.withColumns({name: _number(totals[name]) for name in overall or {}})
    kinds = {f.name: f.dataType for f in groups.schema}
    return picked.withColumns({name: F.lit(one[name]).cast(kinds[name]) for name in also})


def _narrowed(rows: DataFrame, groups: DataFrame, by: Sequence[str], probs: Sequence[float], accuracy: int, small: bool) -> DataFrame:
    """`groups` with brackets that hold about 4 of 1,000 parts of the rows in the old ones; written down by a pass."""
    k, grid = len(probs), [i / GRID for i in range(GRID + 1)]
    tagged = join_table(rows, groups.select(*by, "_lo", "_hi"), by, small=small) if by else rows.crossJoin(F.broadcast(groups.select("_lo", "_hi")))
    v = F.col("_v")
    inside = [v.between(F.col("_lo")[i], F.col("_hi")[i]) for i in range(k)]
    seen = tagged.groupBy(*by).agg(
        F.array(*[F.count_if(v < F.col("_lo")[i]) for i in range(k)]).alias("_below"),
        F.array(*[F.count_if(c) for c in inside]).alias("_in"),
        *[F.percentile_approx(F.when(c, v), grid, accuracy).alias(f"_m{i}") for i, c in enumerate(inside)],
    )
    both = join_table(groups, seen, by, "left") if by else groups.crossJoin(F.broadcast(seen))

    def mark(i: int, step: int) -> Column:
        """The mark two steps before or after the place of the wanted rank; the old edge where there is none."""
        rank = (F.col("_n") - 1) * F.lit(float(probs[i]))
        rank = F.floor(rank) if step < 0 else F.ceil(rank)
        part = (rank - F.col("_below")[i]) / F.col("_in")[i] * GRID
        at = (F.floor(part) if step < 0 else F.ceil(part)).cast("int") + step
        old = F.col("_lo" if step < 0 else "_hi")[i]
        return F.when(at.between(0, GRID), F.get(F.col(f"_m{i}"), at)).otherwise(old)

    lo, hi = (F.array(*[F.coalesce(mark(i, step), F.col(c)[i]) for i in range(k)]) for step, c in ((-2, "_lo"), (2, "_hi")))
    out = both.select(*[c for c in groups.columns if c not in ("_lo", "_hi")], lo.alias("_lo"), hi.alias("_hi"))
    pinned = pin_small(out)
    return out.persist() if pinned is None else pinned


def median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    """Exact median per group."""
    return quantiles(df, value, [0.5], by).withColumnRenamed("q0", name)


def unpivot(
    df: DataFrame, values: Sequence[str], ids: Sequence[str] = (), variable: str = "variable", value: str = "value"
) -> DataFrame:
    """Wide to long; the value columns are read as one type."""
    return df.unpivot(list(ids), list(values), variable, value)


def quantiles_of(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Quantiles of several columns at once: one row per (variable, group). `also` aggregates `value`."""
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return quantiles(unpivot(doubles, cols, by), "value", probs, ["variable", *by], also)
