"""Exact, repeatable samples and splits.

A row's place is its md5 under (seed, key). To take exactly t rows of a class, the t-th smallest hash of
the class is found by counting hash prefixes (evenly filled by construction) and then ordering only the
prefix that holds it. The sample itself is a comparison with that cutoff: rows are never ranked in one
task, nor shuffled. Keys must identify rows; copies of one key stay together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padronix.functions.text import row_hash
from padronix.operators.sizing import join_table, pin_small

PREFIX_DIGITS = 3
TASK_ROWS = 5_000_000


def _holding(counts: DataFrame, group: Sequence[str], want: Column) -> DataFrame:
    """The prefixes holding wanted ranks, with each rank counted from the prefix's start.

    `counts` has rows per (group, _q), `want` is an array of (t: the rank asked for, r: the rank in the group).
    """
    order = Window.partitionBy(*group).orderBy("_q").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_cum", F.sum("_c").over(order)).withColumn("_one", F.explode(want))
    start = F.col("_cum") - F.col("_c")
    hit = placed.where((F.col("_one.r") > start) & (F.col("_one.r") <= F.col("_cum")))
    return hit.withColumn("_w", F.struct(F.col("_one.t").alias("t"), (F.col("_one.r") - start).alias("r")))


def hash_cutoffs(
    df: DataFrame,
    by: Sequence[str],
    targets: Callable[[Column], Column],
    of_smallest: bool = False,
    task_rows: int | None = None,
) -> DataFrame:
    """Per group an array of (t, h), h being the t-th smallest `_h` of the group.

    `targets` maps the group size (or, `of_smallest`, the size of the smallest group) to an array of
    1-based ranks; ranks outside 1..n are ignored. Prefixes are lengthened until none that is to be ordered
    holds more than `task_rows` rows. Runs a small job per prefix length when called.
    """
    by, digits, limit = list(by), PREFIX_DIGITS, task_rows or TASK_ROWS
    rows = df.select(*by, "_h")
    counts = rows.groupBy(*by, F.substring("_h", 1, digits).alias("_q")).agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    if of_smallest:
        counts = counts.withColumn("_n", counts.agg(F.min("_n").alias("m")).scalar())
    counts = counts.withColumn("_t", targets(F.col("_n")))
    want = F.transform("_t", lambda t: F.struct(t.alias("t"), t.alias("r")))
    group = by
    while True:
        held = _holding(counts, group, want).groupBy(*by, F.col("_q").alias("_p"))
        wanted = held.agg(F.collect_list("_w").alias("_w"), F.max("_c").alias("_c"))
        local = pin_small(wanted)
        wanted = wanted.persist() if local is None else local
        largest = wanted.agg(F.max("_c").alias("m")).first()["m"] or 0
        inside = join_table(
            rows.withColumn("_p", F.substring("_h", 1, digits)), wanted.drop("_c"), [*by, "_p"], small=local is not None
        )
        group, want = [*by, "_p"], F.col("_v")
        finer = largest > limit and digits < 30
        digits += PREFIX_DIGITS
        step = F.substring("_h", 1, digits) if finer else F.col("_h")
        # copies of a hash combine here, so they do not gather either
        counts = inside.groupBy(*group, step.alias("_q")).agg(F.count(F.lit(1)).alias("_c"), F.first("_w").alias("_v"))
        if not finer:
            break
    hit = _holding(counts, group, want)
    cut = F.struct(F.col("_w.t").alias("t"), F.col("_q").alias("h"))
    return hit.groupBy(*by).agg(F.array_sort(F.collect_list(cut)).alias("_cut"))


def _hashed(df: DataFrame, seed: int, key: Sequence[str], order: str | None = None) -> DataFrame:
    return df.withColumn("_h", F.col(order) if order else row_hash(seed, *key))


def _one_rank(rank: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda n: F.array(rank(n).cast("long"))


def sample_n(df: DataFrame, n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run."""
    hashed = _hashed(df, seed, key)
    cut = hash_cutoffs(hashed, [], _one_rank(lambda total: F.least(F.lit(n), total)))
    return hashed.where(F.col("_h") <= cut.select(F.col("_cut")[0]["h"]).scalar()).drop("_h")


def stratified_split(
    df: DataFrame, label: str, p: float, seed: int, key: Sequence[str], name: str = "is_train"
) -> DataFrame:
    """Flag ceil(p n) rows of every class as training rows."""
    hashed = _hashed(df, seed, key)
    # the rounding keeps p n from passing a whole number by a floating point error
    cut = hash_cutoffs(hashed, [label], _one_rank(lambda n: F.ceil(F.round(n * F.lit(p), 6))))
    out = join_table(hashed, cut, [label], "left")
    inside = F.coalesce(F.col("_h") <= F.col("_cut")[0]["h"], F.lit(False))
    return out.withColumn(name, inside).drop("_h", "_cut")


def downsample(df: DataFrame, label: str, seed: int, key: Sequence[str], order: str | None = None) -> DataFrame:
    """Keep as many rows of every class as the smallest class has.

    `order` names a column that already holds the rows' hashes, in place of seed and key.
    """
    hashed = _hashed(df, seed, key, order)
    cut = hash_cutoffs(hashed, [label], _one_rank(lambda n: n), of_smallest=True)
    return join_table(hashed, cut, [label]).where(F.col("_h") <= F.col("_cut")[0]["h"]).drop("_h", "_cut")


def assign_folds(
    df: DataFrame,
    label: str,
    k: int,
    seed: int,
    key: Sequence[str],
    name: str = "fold",
    order: str | None = None,
) -> DataFrame:
    """Stratified folds 0..k-1 of equal size (the first ones hold one row more where n is not a multiple).

    `order` names a column that already holds the rows' hashes, in place of seed and key.
    """
    hashed = _hashed(df, seed, key, order)

    def ends(n: Column) -> Column:
        size, extra = F.floor(n / k).cast("long"), F.pmod(n, F.lit(k)).cast("long")
        return F.array(*[F.lit(i) * size + F.least(F.lit(i).cast("long"), extra) for i in range(1, k)])

    cut = hash_cutoffs(hashed, [label], lambda n: F.array_distinct(ends(n)))
    out = join_table(hashed, cut, [label], "left")
    passed = F.size(F.filter(F.coalesce("_cut", F.array()), lambda c: c["h"] < F.col("_h")))
    return out.withColumn(name, passed).drop("_h", "_cut")
