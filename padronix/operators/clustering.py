"""Clustering of group tables, or of raw rows: only plain Euclidean silhouettes compare all pairs of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padronix.operators.cleaning import fill_nonfinite
from padronix.operators.features import Scaling, fit_scaling, varying
from padronix.operators.quality import n_distinct
from padronix.operators.quantiles import quantiles
from padronix.operators.sizing import pin_small
from padronix.operators.threads import side_by_side

MEASURES = ("euclidean", "squaredEuclidean")
POOL = 4096  # random rows that starts are drawn from
ROWS_AT_ONCE = 2048  # rows whose distances to all centres a task holds
BLOCK_POINTS = 1_000  # points that each row is compared with at a time
FEW_CLUSTERS = 50  # clusters whose distances are spelled out, one expression each


def group_features(
    df: DataFrame, by: Sequence[str], share: str, size: str, exported: Column, small: Column, area: str, min_n: int
) -> DataFrame:
    """Feature row per group of at least `min_n` rows."""
    features = {
        "n": F.count(F.lit(1)),
        "mean_share": F.avg(share),
        "mean_size": F.avg(size),
        "export_rate": F.avg(exported.cast("double")),
        "small_share": F.avg(small.cast("double")),
        "areas": n_distinct(area),
    }
    groups = quantiles(df, share, [0.5], by, also=features)
    return groups.where(F.col("n") >= min_n).withColumnRenamed("q0", "median_share")


@dataclass(frozen=True)
class Prepared:
    """Scaled group table: a `features` vector beside the original columns."""

    table: DataFrame
    cols: list[str]
    scaling: Scaling


def prepare(groups: DataFrame, cols: Sequence[str]) -> Prepared:
    """Drop constant columns, z-score the others with gaps filled by 0, and assemble. A small table is computed once.

    Only the `z_` copies are filled; the columns themselves keep their gaps and types.
    """
    small = pin_small(groups)
    groups = groups if small is None else small.coalesce(1)
    kept = varying(groups, cols)
    copies = [f"z_{c}" for c in kept]
    wide = fill_nonfinite(groups.select("*", *[F.col(c).alias(f"z_{c}") for c in kept]), copies)
    fitted = fit_scaling(wide, copies)
    scaling = Scaling({c: fitted.mean[f"z_{c}"] for c in kept}, {c: fitted.sd[f"z_{c}"] for c in kept})
    z = fitted.apply(wide)
    table = VectorAssembler(inputCols=[f"z_{c}" for c in kept], outputCol="features").transform(z)
    return Prepared(table, kept, scaling)


@dataclass(frozen=True)
class Centres:
    """The centres of a clustering in scaled units, and its within sum of squares."""

    points: list[list[float]]
    cost: float

    def clusterCenters(self) -> list[list[float]]:
        return self.points

    def transform(self, table: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        """`table` with the number of the nearest centre, the first of equally near ones."""

        def gap(c: Sequence[float]) -> Column:
            parts = [(F.col("_x")[j] - float(v)) * (F.col("_x")[j] - float(v)) for j, v in enumerate(c)]
            return reduce(add, parts)  # plain sums, which Spark compiles

        placed = table.withColumn("_x", vector_to_array(features)).withColumn("_g", F.array(*[gap(c) for c in self.points]))
        nearest = F.array_position("_g", F.array_min("_g")) - 1
        return placed.withColumn(prediction, nearest.cast("int")).drop("_x", "_g")


def kmeans_all(
    table: DataFrame, ks: Sequence[int], nstart: int = 25, seed: int = 42, steps: int = 50, tolerance: float = 1e-6, features: str = "features"
) -> dict[int, Centres]:
    """For each k the centres of lowest cost among `nstart` random starts.

    All starts of all k move together: one pass over the rows per step assigns them to every set of centres, and one
    aggregate adds up counts, sums and costs of all centres. Starts are distinct rows out of POOL random ones. A set stops
    when no centre moves by more than the tolerance; an empty cluster keeps its centre. The driver holds the centres.
    """
    rows = table.select(vector_to_array(features).alias("x"))
    spread = F.xxhash64("x", F.lit(seed))
    pool = np.array([r["x"] for r in rows.distinct().orderBy(spread, "x").limit(POOL).collect()], float)
    if not len(pool):
        raise ValueError("there are no rows to cluster")
    sets = []
    for k in ks:
        for start in range(nstart):
            picked = np.random.default_rng([seed, k, start]).permutation(len(pool))[:k]
            sets.append((k, pool[picked]))
    blocks = _blocks(rows, pool.shape[1]).persist()
    try:
        return _moved(blocks, sets, steps, tolerance)
    finally:
        blocks.unpersist()


def _moved(blocks: DataFrame, sets: list[tuple[int, np.ndarray]], steps: int, tolerance: float) -> dict[int, Centres]:
    """For each k the best of the sets of centres, moved until they stay."""
    best: dict[int, Centres] = {}
    for step in range(steps + 1):
        following = []
        for (k, centres), (count, sums, cost) in zip(sets, _assigned(blocks, [c for _, c in sets]), strict=True):
            moved = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
            if step < steps and ((moved - centres) ** 2).sum(axis=1).max() > tolerance**2:
                following.append((k, moved))
            elif k not in best or cost < best[k].cost:
                best[k] = Centres(centres.tolist(), cost)
        sets = following
        if not sets:
            break
    return best


def _blocks(rows: DataFrame, d: int) -> DataFrame:
    """Rows (x: array of d doubles) packed, up to ROWS_AT_ONCE together: vectors are unpacked once, not in every pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            some = [whole[low : low + ROWS_AT_ONCE].tobytes() for low in range(0, len(whole), ROWS_AT_ONCE)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["block"])

    return rows.mapInArrow(run, "block binary")


def _assigned(blocks: DataFrame, sets: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(rows per centre, their sums, within sum of squares) of each set of centres."""
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in sets])))
    every = np.concatenate(sets)
    m, d = every.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, d + 2))
        squares = (every**2).sum(axis=1)
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer(), np.float64).reshape(-1, d)
                gaps = squares - 2 * x @ every.T
                for a, b in pairwise(offsets):
                    own = gaps[:, a:b].argmin(axis=1) + a
                    total[:, 0] += np.bincount(own, minlength=m)
                    total[:, 1] += np.bincount(own, ((x - every[own]) ** 2).sum(axis=1), m)
                    for j in range(d):
                        total[:, j + 2] += np.bincount(own, x[:, j], m)
        flat = total.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["cell", "total"])

    out = np.zeros(m * (d + 2))
    for r in blocks.mapInArrow(run, "cell bigint, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect():
        out[r["cell"]] = r["total"]
    out = out.reshape(m, d + 2)
    return [(out[a:b, 0], out[a:b, 2:], float(out[a:b, 1].sum())) for a, b in pairwise(offsets)]


def kmeans_best(table: DataFrame, k: int, nstart: int = 25, seed: int = 42) -> Centres:
    """The centres of lowest cost among `nstart` random starts; `table` should be cached."""
    return kmeans_all(table, [k], nstart, seed)[k]


def total_ss(table: DataFrame, cols: Sequence[str]) -> float:
    """Total sum of squares about the mean."""
    row = table.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(c) for c in cols]).first()
    return row["n"] * sum(row[c] or 0.0 for c in cols)


def k_curves(
    prepared: Prepared, ks: Sequence[int], nstart: int, seed: int = 42, parallelism: int = 8, measure: str = "euclidean"
) -> DataFrame:
    """Within sum of squares (elbow) and mean silhouette per k, by the measure asked for, whatever the table's size.

    k = 1 has the total sum of squares and no silhouette. "euclidean" compares all pairs of rows and suits group
    tables; "squaredEuclidean" passes over the rows once.
    """
    table = prepared.table
    z = [f"z_{c}" for c in prepared.cols]
    models = kmeans_all(table, [k for k in ks if k > 1], nstart, seed)

    def curve(k: int) -> tuple[int, float, float | None, str | None]:
        if k == 1:
            return 1, total_ss(table, z), None, None
        widths = silhouette_points(models[k].transform(table), z, "prediction", measure=measure)
        return k, models[k].cost, widths.agg(F.avg("width")).first()[0], measure

    out = side_by_side(table.sparkSession, curve, ks, parallelism)
    return table.sparkSession.createDataFrame(out, "k int, wss double, silhouette double, measure string")


def _width(own_n: Column, own: Column, other: Column) -> Column:
    """Silhouette width from the mean distances to the own and to the nearest other cluster; 0 for a lone row."""
    return F.when(own_n == 1, 0.0).otherwise(F.try_divide(other - own, F.greatest(own, other)))


def silhouette_points(
    table: DataFrame, cols: Sequence[str], cluster: str, keep: Sequence[str] = (), measure: str = "euclidean"
) -> DataFrame:
    """Silhouette width of every row, for tables of any size.

    "squaredEuclidean" needs each cluster's size, sums and squares only (one small aggregate when called, then one pass).
    "euclidean" needs all distances: rows meet blocks of BLOCK_POINTS points of one cluster, and the sums over blocks are
    added up per row. No task holds more than a block beside its rows.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    rows = table.select(*keep, F.col(cluster).cast("int").alias("_c"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    if measure == "squaredEuclidean":
        return _squared_widths(rows, len(cols), keep)
    return _plain_widths(rows, keep)


def _squared_widths(rows: DataFrame, dims: int, keep: Sequence[str]) -> DataFrame:
    def square(x: Column) -> Column:
        return reduce(add, [x[i] * x[i] for i in range(dims)])

    means = F.array(*[F.avg(F.col("_x")[i]) for i in range(dims)])
    stats = rows.groupBy("_c").agg(F.count(F.lit(1)).alias("m"), means.alias("mean"), F.avg(square(F.col("_x"))).alias("sq"))
    few = stats.limit(FEW_CLUSTERS + 1).collect()
    if not few or len(few) > FEW_CLUSTERS:
        return _squared_widths_of_many(rows, stats, square, keep)
    size, own, others = [], [], []
    for g in few:
        dot = reduce(add, [F.lit(v) * F.col("_x")[i] for i, v in enumerate(g["mean"])])
        d = F.greatest(square(F.col("_x")) + F.lit(g["sq"]) - 2 * dot, F.lit(0.0))
        here = F.col("_c") == F.lit(g["_c"])
        size.append(F.when(here, F.lit(g["m"])))
        own.append(F.when(here, d * g["m"] / (g["m"] - 1) if g["m"] > 1 else d))
        others.append(F.when(~here, d))
    # Columns of their own, as the width names each of them several times.
    placed = rows.withColumns({"_m": F.coalesce(*size), "_a": F.coalesce(*own), "_b": F.least(F.lit(None).cast("double"), *others)})
    return placed.select(*keep, F.col("_c").alias("cluster"), _width(F.col("_m"), F.col("_a"), F.col("_b")).alias("width"))


def _squared_widths_of_many(rows: DataFrame, stats: DataFrame, square: Callable[[Column], Column], keep: Sequence[str]) -> DataFrame:
    every = stats.agg(F.collect_list(F.struct("_c", "m", "mean", "sq")).alias("g")).scalar()

    def distance(g: Column) -> Column:
        dot = F.aggregate(F.zip_with(g["mean"], F.col("_x"), lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
        d = F.greatest(square(F.col("_x")) + g["sq"] - 2 * dot, F.lit(0.0))
        own = g["_c"] == F.col("_c")
        return F.struct(g["_c"].alias("c"), g["m"].alias("m"), F.when(own & (g["m"] > 1), d * g["m"] / (g["m"] - 1)).otherwise(d).alias("d"))

    measured = rows.withColumn("_all", every).withColumn("_g", F.transform("_all", distance))
    own = F.filter("_g", lambda g: g["c"] == F.col("_c"))[0]
    near = F.array_min(F.transform(F.filter("_g", lambda g: g["c"] != F.col("_c")), lambda g: g["d"]))
    return measured.select(*keep, F.col("_c").alias("cluster"), _width(own["m"], own["d"], near).alias("width"))


def _plain_widths(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    # Equal rows have equal widths: they are one row with a count, which also names it in the grouping below.
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    names = [f"_k{i}" for i in range(len(keep))]
    distinct = rows.select(*kept, "_c", "_x").groupBy(*names, "_c", "_x").agg(F.count(F.lit(1)).alias("_n"))
    points = rows.groupBy("_c", "_x").agg(F.count(F.lit(1)).alias("n"))
    sizes = points.groupBy("_c").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("distinct"))
    placed = points.join(sizes, "_c").withColumn("block", F.pmod(F.xxhash64("_x"), F.ceil(F.col("distinct") / BLOCK_POINTS)))
    blocks = placed.groupBy(F.col("_c").alias("c"), "m", "block").agg(F.collect_list(F.struct(F.col("_x").alias("x"), "n")).alias("xs"))

    def total(x: Column, p: Column) -> Column:
        gaps = F.zip_with(p["x"], x, lambda a, b: (a - b) * (a - b))
        return p["n"] * F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda a, v: a + v))

    every = blocks.agg(F.collect_list(F.struct("c", "block"))).scalar()
    asked = distinct.withColumn("_all", every).select(*names, "_c", "_x", "_n", F.explode("_all").alias("_b"))
    asked = asked.select(*names, "_c", "_x", "_n", F.col("_b.c").alias("c"), F.col("_b.block").alias("block"))
    met = asked.join(blocks, ["c", "block"]).select(
        *names, "_c", "_x", "_n", "c", "m", F.aggregate("xs", F.lit(0.0), lambda a, p: a + total(F.col("_x"), p)).alias("d")
    )
    by = [*names, "_c", "_x", "_n"]
    per = met.groupBy(*by, "c", "m").agg(F.sum("d").alias("d"))
    own = F.col("c") == F.col("_c")
    sides = per.groupBy(*by).agg(
        F.max(F.when(own, F.col("m"))).alias("m"),
        F.max(F.when(own & (F.col("m") > 1), F.col("d") / (F.col("m") - 1))).alias("a"),
        F.min(F.when(~own, F.col("d") / F.col("m"))).alias("b"),
    )
    again = sides.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    back = [F.col(n).alias(c) for n, c in zip(names, keep, strict=True)]
    return again.select(*back, F.col("_c").alias("cluster"), _width(F.col("m"), F.col("a"), F.col("b")).alias("width"))


def silhouette_grade(c: Column) -> Column:
    return F.when(c > 0.7, "excellent").when(c > 0.5, "good").when(c > 0.25, "fair").otherwise("low")


def cluster_quality(table: DataFrame, cols: Sequence[str], cluster: str, digits: int = 6) -> DataFrame:
    """Within, between and total sum of squares, their ratio, and explained percentage."""
    per = table.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.var_pop(c).alias(f"_v{i}") for i, c in enumerate(cols)],
    )
    within = F.sum(F.col("_n") * sum(F.col(f"_v{i}") for i in range(len(cols))))
    all_rows = table.agg((F.count(F.lit(1)) * sum(F.var_pop(c) for c in cols)).alias("t")).scalar()
    out = per.agg(within.alias("w"), F.count(F.lit(1)).alias("clusters")).withColumn("t", all_rows)
    ratio = (F.col("t") - F.col("w")) / F.col("t")
    return out.select(
        "clusters",
        F.round("w", digits).alias("wss"),
        F.round(F.col("t") - F.col("w"), digits).alias("bss"),
        F.round("t", digits).alias("tss"),
        F.round(ratio, 4).alias("bss_ratio"),
        F.round(ratio * 100, 2).alias("pct_explained"),
    )


def cluster_profile(assigned: DataFrame, cluster: str, means: Mapping[str, int], total: str = "n") -> DataFrame:
    """Per cluster: groups, rows, and the mean of each listed column at its own rounding."""
    return assigned.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.sum(total).alias("n_rows"),
        *[F.round(F.avg(c), d).alias(f"avg_{c}") for c, d in means.items()],
    )


def cluster_median(assigned: DataFrame, cluster: str, x: str, digits: int = 3) -> DataFrame:
    """Median of a group feature per cluster."""
    rows = assigned.select(F.col(cluster).alias("cluster"), x)
    out = quantiles(rows, x, [0.5], ["cluster"])
    return out.select("cluster", F.round("q0", digits).alias(f"median_{x}"))


def centroids(prepared: Prepared, model: Centres) -> DataFrame:
    """Cluster centres in scaled and in original units, one row per (cluster, variable)."""
    out = []
    for i, center in enumerate(model.clusterCenters()):
        for c, z in zip(prepared.cols, center):
            sd = prepared.scaling.sd[c] or 1.0
            out.append((i, c, float(z), float(z) * sd + prepared.scaling.mean[c]))
    spark = prepared.table.sparkSession
    return spark.createDataFrame(out, "cluster int, variable string, scaled double, raw double")
