"""Clustering on the nineteen published sector rows (values rounded to six places)."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from padronix.operators import clustering
from padronix.plans import explore

# Section, establishments, mean share, median share, mean size, exporter rate, small share, published group.
SECTORS = [
    ("A", 136544, 0.085556, 0.0, 6.923124, 0.021143, 0.078495, 1),
    ("B", 4792, 0.142358, 0.0, 12.612792, 0.254382, 0.310726, 3),
    ("C", 134388, 0.225822, 0.055556, 10.682174, 0.149091, 0.231925, 3),
    ("D", 3561, 0.180369, 0.076923, 13.813395, 0.067958, 0.35973, 3),
    ("E", 3404, 0.137981, 0.0, 11.333725, 0.012926, 0.258519, 3),
    ("F", 67132, 0.083001, 0.0, 10.178678, 0.012453, 0.211375, 3),
    ("G", 387785, 0.406443, 0.3, 7.716459, 0.028959, 0.110876, 1),
    ("H", 92504, 0.090895, 0.0, 7.620195, 0.024237, 0.106947, 1),
    ("I", 65067, 0.501975, 0.5, 9.246185, 0.009913, 0.173314, 2),
    ("J", 27502, 0.298868, 0.222222, 10.239946, 0.088394, 0.213875, 3),
    ("K", 31823, 0.570351, 0.5625, 9.042658, 0.001697, 0.165006, 2),
    ("L", 46382, 0.390134, 0.0, 5.51396, 0.001337, 0.020978, 1),
    ("M", 69611, 0.531456, 0.5, 6.677774, 0.006479, 0.068481, 2),
    ("N", 66223, 0.401022, 0.318182, 9.132107, 0.006101, 0.168657, 2),
    ("O", 2497, 0.553877, 0.571429, 8.394874, 0.0, 0.138566, 2),
    ("P", 16480, 0.774192, 0.886364, 14.829733, 0.00085, 0.401214, 2),
    ("Q", 54176, 0.820806, 1.0, 8.428354, 0.00467, 0.139933, 2),
    ("R", 18255, 0.528618, 0.5, 7.48825, 0.008929, 0.101561, 2),
    ("S", 138284, 0.413648, 0.166667, 6.26536, 0.000991, 0.051647, 1),
]
COLUMNS = ["n", "mean_share", "median_share", "mean_size", "export_rate", "small_share", "areas"]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(
        SECTORS,
        "section string, n long, mean_share double, median_share double, mean_size double, export_rate double, "
        "small_share double, published int",
    ).withColumn("areas", F.lit(24))
    return explore.cluster_sectors(df, k=3, nstart=25, cols=tuple(COLUMNS))


def test_constant_column_is_dropped(fitted):
    assert fitted[1].cols == COLUMNS[:-1]


def test_published_groups_are_found(fitted):
    pairs = {(r.published, r.cluster) for r in fitted[0].select("published", "cluster").collect()}
    assert len(pairs) == 3 and len({c for _, c in pairs}) == 3


def test_quality_measures(fitted):
    assigned, prepared, model = fitted
    z = [f"z_{c}" for c in prepared.cols]
    assert model.cost == pytest.approx(49.3918, abs=2e-3)
    quality = clustering.cluster_quality(assigned, z, "cluster").first()
    assert quality.wss == pytest.approx(49.3918, abs=2e-3) and quality.bss_ratio == pytest.approx(0.5427, abs=2e-4)
    assert quality.tss == pytest.approx(quality.wss + quality.bss, abs=1e-5)
    assert quality.tss == pytest.approx(18 * 6, abs=1e-6)
    width = clustering.silhouette_points(assigned, z, "cluster", keep=["section"])
    assert width.count() == 19
    mean = width.agg(F.avg("width").alias("w")).withColumn("grade", clustering.silhouette_grade(F.col("w"))).first()
    assert mean.w == pytest.approx(0.3307, abs=2e-4) and mean.grade == "fair"


def test_cluster_profile(fitted):
    rows = {r.n_groups: r for r in explore.cluster_report(fitted[0]).collect()}
    assert {g: r.n_rows for g, r in rows.items()} == {5: 801499, 8: 324132, 6: 240779}
    assert {g: (r.avg_mean_share, r.avg_export_rate) for g, r in rows.items()} == {
        5: (0.277, 0.015), 8: (0.585, 0.005), 6: (0.178, 0.098),
    }
    assert {g: (r.avg_mean_size, r.avg_small_share) for g, r in rows.items()} == {5: (6.8, 0.1), 8: (9.2, 0.2), 6: (11.5, 0.3)}
    # the published table repeats the mean here; this is the true median of the group means
    assert rows[5].median_mean_share == 0.39


def test_centroids_return_to_raw_units(fitted):
    assigned, prepared, model = fitted
    raw = {(r.cluster, r.variable): r.raw for r in clustering.centroids(prepared, model).collect()}
    means = assigned.groupBy("cluster").agg(F.avg("mean_share").alias("m")).collect()
    assert all(raw[(r.cluster, "mean_share")] == pytest.approx(r.m) for r in means)


def test_curves(fitted):
    rows = clustering.k_curves(fitted[1], [1, 2, 3, 4, 5], nstart=10).orderBy("k").collect()
    wss = [r.wss for r in rows]
    assert wss[0] == pytest.approx(108.0) and all(a >= b - 1.0 for a, b in zip(wss, wss[1:]))
    assert rows[0].silhouette is None and all(-1 <= r.silhouette <= 1 for r in rows[1:])


def _brute_widths(points, clusters, distance):
    out = []
    for i, p in enumerate(points):
        mean = {}
        for c in set(clusters):
            ds = [distance(p, q) for j, q in enumerate(points) if clusters[j] == c and j != i]
            mean[c] = sum(ds) / len(ds) if ds else None
        a, b = mean[clusters[i]], min(m for c, m in mean.items() if c != clusters[i])
        out.append(0.0 if a is None else (b - a) / max(a, b))
    return out


@pytest.mark.parametrize("measure", clustering.MEASURES)
def test_silhouettes_of_any_size_by_brute_force(spark, monkeypatch, measure):
    monkeypatch.setattr(clustering, "BLOCK_POINTS", 7)  # blocks of few points
    rng = random.Random(3)
    rows = [(i, rng.random() + c, rng.random(), c) for i, c in enumerate(rng.choices([0, 1, 2], k=120))]
    rows += [(200 + i, *rows[i][1:]) for i in range(10)]  # repeated points
    df = spark.createDataFrame(rows, "id int, x double, y double, c int").repartition(3)
    got = {r.id: r.width for r in clustering.silhouette_points(df, ["x", "y"], "c", keep=["id"], measure=measure).collect()}
    power = 0.5 if measure == "euclidean" else 1
    want = _brute_widths([r[1:3] for r in rows], [r[3] for r in rows], lambda p, q: ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** power)
    assert [got[r[0]] for r in rows] == pytest.approx(want)


def test_gaps_are_filled_in_the_scaled_copies_only(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (2, 7, None), (3, 9, 4.0)], "id int, n long, x double")
    table = clustering.prepare(df, ["n", "x"]).table
    assert dict(table.dtypes)["n"] == "bigint" and table.where("id = 2").first().x is None
    assert table.where("z_x IS NULL").count() == 0


def test_single_member_cluster_has_width_zero(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 0), (9.0, 1)], "x double, c int")
    widths = {r.x: r.width for r in clustering.silhouette_points(df, ["x"], "c", keep=["x"]).collect()}
    assert widths == {0.0: pytest.approx(8 / 9), 1.0: pytest.approx(7 / 8), 9.0: 0.0}


def test_all_starts_together_equal_separate_starts(spark):
    """Every start of every k, moved by itself in plain numpy, ends where the common passes end."""
    import numpy as np
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(m, 0.3, (40, 2)) for m in ((0, 0), (3, 1), (1, 4))] + [np.zeros((5, 2))])
    table = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(3)
    table = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(table).cache()
    found = clustering.kmeans_all(table, [1, 2, 3, 5], nstart=4, seed=9)
    order = F.xxhash64(F.array("a", "b"), F.lit(9))
    pool = np.array([tuple(r) for r in table.select("a", "b").distinct().orderBy(order, F.array("a", "b")).collect()])
    for k, got in found.items():
        costs = []
        for start in range(4):
            c = pool[np.random.default_rng([9, k, start]).permutation(len(pool))[:k]]
            for _ in range(50):
                own = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
                c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)])
            costs.append(float(((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()))
        assert got.cost == pytest.approx(min(costs), rel=1e-6) and len(got.points) == k
    assigned = found[3].transform(table)
    widths = clustering.silhouette_points(assigned, ["a", "b"], "prediction").agg(F.avg("width")).first()[0]
    assert widths > 0.6 and assigned.groupBy("prediction").count().where("count >= 40").count() == 3


def test_kmeans_unpacks_vectors_once(spark, monkeypatch):
    packed = []
    blocks = clustering._blocks
    monkeypatch.setattr(clustering, "_blocks", lambda rows, d: packed.append(d) or blocks(rows, d))
    table = spark.range(5000).selectExpr("array(double(id % 3) * 100 + id / 5000.0, double(id % 7)) AS a").select(array_to_vector("a").alias("features"))
    found = clustering.kmeans_all(table, [1, 3], nstart=4)
    assert packed == [2]
    assert sorted(round(c[0] / 100) for c in found[3].points) == [0, 1, 2]
    xs = np.array([[i % 3 * 100 + i / 5000, i % 7] for i in range(5000)])
    assert abs(found[1].cost - ((xs - xs.mean(axis=0)) ** 2).sum()) < 1e-3


def test_squared_widths_of_few_clusters_are_compiled_and_equal_those_of_many(spark, monkeypatch):
    table = spark.range(300).selectExpr("id", "cast(id % 4 AS int) AS c", "id % 4 * 10 + id / 300.0D AS x", "id % 7 * 1.5D AS y")
    table = table.unionAll(spark.createDataFrame([(300, 9, 99.0, 1.0)], table.schema))  # a lone row
    for rows in (table, table.where("c = 2"), table.limit(0)):
        few = clustering.silhouette_points(rows, ["x", "y"], "c", ["id"], "squaredEuclidean")
        assert "lambda" not in few._jdf.queryExecution().optimizedPlan().toString() or not rows.count()
        monkeypatch.setattr(clustering, "FEW_CLUSTERS", -1)
        many = clustering.silhouette_points(rows, ["x", "y"], "c", ["id"], "squaredEuclidean")
        monkeypatch.undo()
        want = {r.id: (r.cluster, r.width) for r in many.collect()}
        got = {r.id: (r.cluster, r.width) for r in few.collect()}
        assert got.keys() == want.keys()
        for i, (cluster, width) in got.items():
            assert cluster == want[i][0] and width == (want[i][1] if want[i][1] is None else pytest.approx(want[i][1], abs=1e-9))
