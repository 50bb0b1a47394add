"""Samples, splits and folds: exact sizes, repeatable, without ranking all rows."""

import math

import pytest
from pyspark.sql import functions as F

from padronix.functions.text import row_hash
from padronix.operators.sampling import assign_folds, downsample, hash_cutoffs, sample_n, stratified_split


def table(spark, sizes):
    df = None
    for label, n in sizes.items():
        part = spark.range(n).select(F.lit(label).alias("y"), F.col("id").alias("k"), (F.col("id") % 7).alias("x"))
        df = part if df is None else df.unionByName(part)
    return df


SIZES = {"a": 10, "b": 997, "c": 1, None: 13}
KEY = ["y", "k"]


@pytest.mark.parametrize("p", [0.8, 0.5, 0.7, 1.0])
def test_split_takes_the_ceiling_per_class(spark, p):
    out = stratified_split(table(spark, SIZES), "y", p, 42, KEY)
    got = {r.y: (r.n, r.t) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t")).collect()}
    assert got == {y: (n, math.ceil(round(n * p, 6))) for y, n in SIZES.items()}


def test_split_is_repeatable_whatever_the_partitioning(spark):
    df = table(spark, SIZES)
    one = stratified_split(df.coalesce(1), "y", 0.8, 42, KEY).where("is_train").select(*KEY)
    many = stratified_split(df.repartition(9), "y", 0.8, 42, KEY).where("is_train").select(*KEY)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    other = stratified_split(df, "y", 0.8, 43, KEY).where("is_train").select(*KEY)
    assert other.exceptAll(one).count() > 0


@pytest.mark.parametrize("task_rows", [1, 3])
def test_longer_prefixes_give_the_same_cutoffs(spark, task_rows):
    df = table(spark, {"a": 300, "b": 40}).withColumn("_h", row_hash(1, *KEY))

    def ranks(n):
        return F.array(F.lit(1).cast("long"), n, F.ceil(n / 2).cast("long"), n + 5)

    want = {}
    for y, n in {"a": 300, "b": 40}.items():
        hashes = sorted(r._h for r in df.where(F.col("y") == y).collect())
        want[y] = [(1, hashes[0]), (n // 2, hashes[n // 2 - 1]), (n, hashes[-1])]
    for limit in (None, task_rows):
        got = {r.y: [(c.t, c.h) for c in r._cut] for r in hash_cutoffs(df, ["y"], ranks, task_rows=limit).collect()}
        assert got == want


def test_split_by_the_shuffle_path(spark, no_small_tables):
    out = stratified_split(table(spark, SIZES), "y", 0.8, 42, KEY)
    assert out.count() == sum(SIZES.values())
    assert out.where("y = 'b' and is_train").count() == 798


@pytest.mark.parametrize("k", [2, 3, 5])
def test_folds_are_even_and_cover_every_row(spark, k):
    out = assign_folds(table(spark, SIZES), "y", k, 1, KEY)
    assert out.count() == sum(SIZES.values())
    for y, n in SIZES.items():
        sizes = [r["count"] for r in out.where(F.col("y").eqNullSafe(y)).groupBy("fold").count().orderBy("fold").collect()]
        assert sizes == [n // k + (i < n % k) for i in range(k) if n // k + (i < n % k)]


def test_downsample_to_the_smallest_class(spark):
    out = downsample(table(spark, {"a": 50, "b": 1000, "c": 51}), "y", 3, KEY)
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {"a": 50, "b": 50, "c": 50}


@pytest.mark.parametrize("n", [1, 100, 1010, 5000])
def test_sample_size(spark, n):
    df = table(spark, {"a": 10, "b": 1000})
    out = sample_n(df, n, 42, KEY)
    assert out.count() == min(n, 1010) and out.distinct().count() == out.count()
    assert set(out.columns) == {"y", "k", "x"}


def test_many_copies_of_one_key_stay_together(spark):
    df = table(spark, {"a": 100}).unionByName(spark.range(400).select(F.lit("a").alias("y"), F.lit(5).cast("long").alias("k"), F.lit(0).cast("long").alias("x")))
    out = stratified_split(df, "y", 0.5, 42, KEY)
    assert out.where("k = 5").select("is_train").distinct().count() == 1


def test_rows_are_not_shuffled_to_be_split(spark):
    plan = stratified_split(table(spark, {"a": 50, "b": 50}), "y", 0.8, 42, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
