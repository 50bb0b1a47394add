"""Clustering of brands by their lines."""

from pyspark.sql import functions as F

from padronix.operators import clustering
from padronix.plans import explore
from padronix.plans.catalog.base import STAR, query
from padronix.plans.star import star

FEATURES = ["mean_share", "mean_size", "export_rate", "small_share", "areas"]
MIN_BRAND = 20
GROUPS = f"""SELECT p_brand, count(*) AS n, avg(share) AS mean_share, avg(l_quantity) AS mean_size,
  avg(CASE WHEN exported THEN 1.0 ELSE 0.0 END) AS export_rate, avg(CASE WHEN p_size <= 10 THEN 1.0 ELSE 0.0 END) AS small_share,
  count(DISTINCT n_name) AS areas, median(share) AS median_share
FROM ({STAR}) GROUP BY 1 HAVING count(*) >= {MIN_BRAND}"""


def brands(spark, d):
    return clustering.group_features(
        star(spark, d), ["p_brand"], "share", "l_quantity", F.col("exported"), F.col("p_size") <= 10, "n_name", MIN_BRAND
    )


ROUNDED = ["mean_share", "mean_size", "export_rate", "small_share", "median_share"]


@query(f"SELECT p_brand, n, areas, {', '.join(f'round({c}, 6) AS {c}' for c in ROUNDED)} FROM ({GROUPS})")
def group_features(spark, d):
    return brands(spark, d).withColumns({c: F.round(c, 6) for c in ROUNDED})


# A fixed assignment, so that both engines measure the same clusters.
RULE = "CASE WHEN export_rate > (SELECT avg(export_rate) FROM g) THEN 1 ELSE 0 END"
POINTS = ["mean_share", "mean_size", "export_rate"]


def assigned(spark, d):
    groups = brands(spark, d).select("p_brand", *POINTS).persist()
    cut = groups.agg(F.avg("export_rate").alias("m")).scalar()
    return groups.withColumn("_m", cut).withColumn("cluster", F.when(F.col("export_rate") > F.col("_m"), 1).otherwise(0))


def _ss(columns, by):
    return " + ".join(f"sum(({c} - m_{c}) ** 2)" for c in columns)


@query(f"""
WITH g AS ({GROUPS}), a AS (SELECT *, {RULE} AS cluster FROM g),
w AS (SELECT *, {", ".join(f"avg({c}) OVER (PARTITION BY cluster) AS m_{c}" for c in POINTS)} FROM a),
t AS (SELECT *, {", ".join(f"avg({c}) OVER () AS m_{c}" for c in POINTS)} FROM a),
s AS (SELECT (SELECT {_ss(POINTS, 'cluster')} FROM w) AS w, (SELECT {_ss(POINTS, None)} FROM t) AS t,
  (SELECT count(DISTINCT cluster) FROM a) AS k)
SELECT k AS clusters, round(w, 6) AS wss, round(t - w, 6) AS bss, round(t, 6) AS tss, round((t - w) / t, 4) AS bss_ratio,
  round((t - w) / t * 100, 2) AS pct_explained
FROM s
""")
def cluster_quality_fixed(spark, d):
    return clustering.cluster_quality(assigned(spark, d), POINTS, "cluster")


@query(f"""
WITH g AS ({GROUPS}), a AS (SELECT *, {RULE} AS cluster FROM g),
p AS (SELECT x.p_brand, x.cluster, y.cluster AS other, count(*) AS m,
  sum(sqrt({" + ".join(f"(x.{c} - y.{c}) ** 2" for c in POINTS)})) AS d FROM a x, a y GROUP BY 1, 2, 3),
s AS (SELECT p_brand, cluster, max(m) FILTER (other = cluster) AS own, max(d / (m - 1)) FILTER (other = cluster AND m > 1) AS a,
  min(d / m) FILTER (other <> cluster) AS b FROM p GROUP BY 1, 2)
SELECT p_brand, cluster, round(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS width FROM s
""")
def silhouette_fixed(spark, d):
    points = clustering.silhouette_points(assigned(spark, d), POINTS, "cluster", keep=["p_brand"])
    return points.withColumn("width", F.round("width", 6))


def _prepared(spark, d):
    prepared = clustering.prepare(brands(spark, d).persist(), FEATURES)
    return clustering.Prepared(prepared.table.persist(), prepared.cols, prepared.scaling)


@query()
def k_curves(spark, d):
    return clustering.k_curves(_prepared(spark, d), range(1, 11), nstart=25)


@query()
def kmeans_profile(spark, d):
    assigned_brands, _, _ = explore.cluster_sectors(brands(spark, d).persist(), k=3, nstart=25, cols=tuple(FEATURES))
    return explore.cluster_report(assigned_brands)


@query()
def kmeans_centroids(spark, d):
    prepared = _prepared(spark, d)
    return clustering.centroids(prepared, clustering.kmeans_best(prepared.table, 3, nstart=25))
