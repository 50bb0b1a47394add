"""Joins whose strategy follows a measured size.

A side is broadcast only after its rows and bytes were counted against bounds. Past them the rows are
joined by a shuffle on (key, salt): keys of many rows are spread over many tasks, other keys have one salt.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000
SMALL_BYTES = 64_000_000
SALTS = 32
HOT_ROWS = 1_000_000  # rows of a key from which its rows are spread


def fetch_small(table: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int | None = None) -> pa.Table | None:
    """The rows of `table`, or None when there are more than `max_rows` of them, or more than `max_bytes` of data.

    Rows come in one partition after another, so what is fetched in vain is bounded as well.
    """
    limit = SMALL_BYTES if max_bytes is None else max_bytes
    rows = table.limit(max_rows + 1).toArrow()
    return rows if rows.num_rows <= max_rows and rows.nbytes <= limit else None


def pin_small(table: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """`table` as a local relation when it is small, so that it is computed once."""
    rows = fetch_small(table, max_rows)
    return None if rows is None else table.sparkSession.createDataFrame(rows, schema=table.schema)


def join_table(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = SMALL_ROWS,
    salts: int = SALTS,
    small: bool | None = None,
) -> DataFrame:
    """Join rows with a per-key table (unique on `on`); NULL keys match each other.

    Small tables are broadcast. Of a larger one, the keys that `df` holds over HOT_ROWS times are repeated once
    per salt, all others once: every row meets exactly one copy. The hot keys are counted in one pass, which
    combines before its shuffle; if too many are hot for a broadcast, all keys are repeated. `small` tells the outcome of a
    check already made (of this table, or of another with the same groups).
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"join_table does not support {how!r}")
    renamed = table.withColumnsRenamed({k: f"__{k}" for k in on})
    if small is None:
        local = pin_small(renamed, max_rows)
    else:
        local = renamed if small else None
    if local is not None:
        right, left, pairs = F.broadcast(local), df, [(k, f"__{k}") for k in on]
    else:
        counts = df.groupBy(*[F.col(k).alias(f"__h_{k}") for k in on]).agg(F.count(F.lit(1)).alias("__rows"))
        hot = counts.where(F.col("__rows") > HOT_ROWS).select(*[f"__h_{k}" for k in on], F.lit(True).alias("__hot"))
        known = pin_small(hot)  # more hot keys than that: every key gets all salts

        def marked(side: DataFrame, prefix: str) -> DataFrame:
            if known is None:
                return side.withColumn("__hot", F.lit(True))
            same = [F.col(f"{prefix}{k}").eqNullSafe(F.col(f"__h_{k}")) for k in on]
            return side.join(F.broadcast(known), reduce(lambda a, b: a & b, same), "left").drop(*[f"__h_{k}" for k in on])

        fan = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        right = marked(renamed, "__").withColumn("__salt_r", F.explode(fan)).drop("__hot")
        spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
        salt = F.when(F.col("__hot"), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0)
        left = marked(df, "").withColumn("__salt", salt).drop("__hot")
        pairs = [*((k, f"__{k}") for k in on), ("__salt", "__salt_r")]
    condition = None
    for a, b in pairs:
        term = F.col(a).eqNullSafe(F.col(b)) if a != "__salt" else F.col(a) == F.col(b)
        condition = term if condition is None else condition & term
    return left.join(right, condition, how).drop("__salt", "__salt_r", *[f"__{k}" for k in on])


def fuller(kept: DataFrame, rows_per_task: int = 20_000, n: int | None = None) -> DataFrame:
    """Rows, read by no more tasks than they fill: for fits that pass over them many times. `n` is their known number.

    Where there are more rows than partitions times `rows_per_task` the partitioning stays as it is.
    """
    return kept.coalesce(max(1, -(-(kept.count() if n is None else n) // rows_per_task)))
