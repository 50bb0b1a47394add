"""Key checks and star joins. All are equi-joins; Spark's own size statistics pick the strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(fact: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Fact keys without a dimension row, with their row counts.

    Facts are grouped first, so that the anti-join sees one row per key whatever the skew.
    """
    keys = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(dim.select(*on).distinct(), list(on), "left_anti")


def orphan_summary(orphans: DataFrame, on: Sequence[str], examples: int = 10) -> DataFrame:
    """Number of orphan keys and fact rows, and the first few keys in key order."""
    label = F.concat_ws("-", *[F.col(k).cast("string") for k in on])
    head = orphans.orderBy(*on).limit(examples).agg(F.array_join(F.array_sort(F.collect_list(label)), ","))
    return orphans.agg(
        F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
    ).withColumn("examples", head.scalar())


def keep_valid(fact: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts whose key exists in the dimension."""
    return fact.join(dim.select(*on), list(on), "left_semi")


def integrate(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "left") -> DataFrame:
    """Join each dimension (already pruned to its wanted columns) on its key.

    With `how="inner"` facts without a dimension row are dropped: with unique keys the same as
    `keep_valid` followed by a left join, in one pass over the dimension.
    """
    for dim, on in dims:
        fact = fact.join(dim, list(on), how)
    return fact


def attach_scalar(df: DataFrame, one_row: DataFrame, column: str, name: str) -> DataFrame:
    """Put a one-row aggregate into every row, as a scalar subquery."""
    return df.withColumn(name, one_row.select(column).scalar())
