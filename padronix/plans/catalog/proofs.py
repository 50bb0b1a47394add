"""What a fitted model must satisfy, whatever the fitting routine: each statement beside the SQL that says so."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from padronix.operators import clustering, correlation, evaluation, models
from padronix.plans import explore
from padronix.plans.catalog import modelling
from padronix.plans.catalog.base import query
from padronix.plans.star import LINE_KEY, lines_parts, table

MEASURED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PAIRS = [(a, b) for a in MEASURED for b in MEASURED if a <= b]


@query(
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a, b in PAIRS)
)
def pca_gives_the_correlations_back(spark, d):
    """All components together: sum of variance x loading x loading is the correlation of two variables."""
    variance, loadings = correlation.principal_components(table(spark, d, "lineitem"), MEASURED, len(MEASURED))
    one = loadings.join(variance, "component")
    other = loadings.select(F.col("variable").alias("b"), "component", F.col("loading").alias("other"))
    both = one.join(other, "component").where(F.col("variable") <= F.col("b"))
    part = F.col("explained") * len(MEASURED) * F.col("loading") * F.col("other")
    return both.groupBy(F.col("variable").alias("a"), "b").agg((F.round(F.sum(part), 6) + 0.0).alias("r"))


# Fitted on all rows, so that the equations hold on the table itself.
FLAGGED = models.Spec(
    label="outcome", positive="returned", categorical=("p_type",), numeric=("l_quantity", "l_discount", "p_size"),
    key=tuple(LINE_KEY), folds=2, down=False,
)


def _flagged(spark, d):
    outcome = F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept").alias("outcome")
    return lines_parts(spark, d).select(*LINE_KEY, outcome, "p_type", "l_quantity", "l_discount", F.col("p_size").cast("double"))


@query("""
SELECT 'rate' AS term, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 4) AS value FROM lineitem
UNION ALL SELECT unnest(['l_quantity', 'l_discount', 'p_size', 'ECONOMY', 'PROMO']) AS term, 0.0 AS value
""")
def logit_satisfies_its_score_equations(spark, d):
    """At the maximum, the residuals have no covariance left with any predictor, and the mean score is the event rate."""
    rows = _flagged(spark, d)
    scored = models.fit_logit(rows, FLAGGED).score(rows)
    residual = (F.col("outcome") == "returned").cast("double") - F.col("score")
    terms = {c: F.col(c) for c in FLAGGED.numeric} | {t: (F.col("p_type") == t).cast("double") for t in ("ECONOMY", "PROMO")}
    items = [F.struct(F.lit("rate").alias("term"), F.round(F.avg("score"), 4).alias("value"))]
    items += [
        F.struct(F.lit(n).alias("term"), F.round(F.abs(F.avg(residual * x) / F.greatest(F.avg(F.abs(x)), F.lit(1e-9))), 3).alias("value"))
        for n, x in terms.items()
    ]
    return scored.agg(F.array(*items).alias("i")).select(F.inline("i"))


# Three groups of lines, far apart in one coordinate: the best clusters are known.
PLANTED = "l_linenumber % 3"
PLACES = f"SELECT l_orderkey, l_partkey, {PLANTED} AS kind, 1000.0 * ({PLANTED}) + l_quantity AS x, l_discount AS y FROM lineitem"
AXES = ["x", "y"]


def _planted(spark, d):
    kind = F.col("l_linenumber") % 3
    return table(spark, d, "lineitem").select(kind.alias("kind"), (kind * 1000.0 + F.col("l_quantity")).alias("x"), F.col("l_discount").alias("y"))


def _clusters(spark, d):
    rows = _planted(spark, d).withColumn("n", F.lit(1).cast("bigint"))
    return explore.cluster_sectors(rows, k=3, nstart=8, cols=("x",))


@query(f"SELECT count(*) AS n_groups, round(avg(x), 2) AS avg_x, round(avg(y), 4) AS avg_y, count(DISTINCT kind) AS kinds FROM ({PLACES}) GROUP BY kind")
def kmeans_finds_planted_groups(spark, d):
    assigned, prepared, _ = _clusters(spark, d)
    profile = clustering.cluster_profile(assigned, "cluster", {"x": 2, "y": 4})
    kinds = assigned.groupBy("cluster").agg(F.count_distinct("kind").alias("kinds"))
    return profile.join(kinds, "cluster").select("n_groups", "avg_x", "avg_y", "kinds")


@query(f"SELECT round(avg(x), 4) AS raw FROM ({PLACES}) GROUP BY kind")
def kmeans_centres_are_group_means(spark, d):
    _, prepared, model = _clusters(spark, d)
    return clustering.centroids(prepared, model).select(F.round("raw", 4).alias("raw"))


@query(f"SELECT 0 AS n_nearer, count(*) AS n_rows FROM ({PLACES})")
def kmeans_rows_are_nearest_to_their_own_centre(spark, d):
    assigned, prepared, model = _clusters(spark, d)
    centres = F.array(*[F.lit(float(c[0])) for c in model.clusterCenters()])
    gaps = F.transform(centres, lambda c: F.abs(c - F.col("z_x")))
    nearer = F.exists(gaps, lambda g: g < F.get(gaps, F.col("cluster")) - 1e-9)
    return assigned.agg(F.count_if(nearer).cast("int").alias("n_nearer"), F.count("*").alias("n_rows"))


@query(f"""
SELECT 1 AS k, round(2.0::DOUBLE * (count(*) - 1), 3) AS wss, true AS falls FROM ({PLACES})
UNION ALL SELECT k, NULL, true FROM (VALUES (2), (3)) AS t(k)
""")
def k_curves_start_at_the_total(spark, d):
    """With one cluster the within sum of squares is the total; it never rises with k."""
    prepared = clustering.prepare(_planted(spark, d), AXES)
    kept = clustering.Prepared(prepared.table.persist(), prepared.cols, prepared.scaling)
    rows = clustering.k_curves(kept, [1, 2, 3], nstart=3, measure="squaredEuclidean")
    kept.table.unpersist()
    before = F.expr("lag(wss) OVER (ORDER BY k)")  # one row per k
    return rows.select(
        "k", F.when(F.col("k") == 1, F.round("wss", 3)).alias("wss"), F.coalesce(F.col("wss") <= before * (1 + 1e-9), F.lit(True)).alias("falls")
    )


# A label that one threshold on a column of few values decides.
DECIDED = models.Spec(
    label="half", positive="late", numeric=("l_linenumber", "l_quantity", "l_tax"), key=tuple(LINE_KEY), folds=2,
    forest={"numTrees": 5, "maxDepth": 4}, mtry=(3,),
)


def _decided(spark, d):
    half = F.when(F.col("l_linenumber") >= 4, "late").otherwise("early").alias("half")
    return table(spark, d, "lineitem").select(*LINE_KEY[:1], *LINE_KEY[2:], half, F.col("l_linenumber").cast("double"), "l_quantity", "l_tax")


def _forest(spark, d):
    rows = _decided(spark, d)
    return rows, models.fit_forest(rows, replace(DECIDED, key=tuple([*LINE_KEY, "l_quantity", "l_tax"])))


@query("""
SELECT 'l_linenumber' AS variable, 100.0::DOUBLE AS importance, count(*) FILTER (l_linenumber >= 4) AS tp, 0 AS fp, 0 AS fn,
  count(*) FILTER (l_linenumber < 4) AS tn, 1.0::DOUBLE AS accuracy FROM lineitem
""")
def forest_learns_a_threshold(spark, d):
    rows, model = _forest(spark, d)
    table_ = evaluation.confusion(model.score(rows), "predicted", "half", "late").select(
        "tp", F.col("fp").cast("int").alias("fp"), F.col("fn").cast("int").alias("fn"), "tn", "accuracy"
    )
    best = models.impurity_importance(model).where("importance = 100").select("variable", "importance")
    return best.join(table_, how="cross")  # one row each


@query("SELECT unnest(['l_quantity', 'l_tax']) AS variable, 0.0::DOUBLE AS raw, 0.0::DOUBLE AS importance UNION ALL SELECT 'l_linenumber', NULL, 100.0")
def shuffling_unused_columns_outside_bags_costs_nothing(spark, d):
    out = models.out_of_bag_importance(_forest(spark, d)[1])
    return out.select("variable", F.when(F.col("variable") != "l_linenumber", F.round("raw", 6)).alias("raw"), "importance")


@query("SELECT unnest(['l_quantity', 'l_tax']) AS variable, 0.0::DOUBLE AS raw, 0.0::DOUBLE AS importance UNION ALL SELECT 'l_linenumber', NULL, 100.0")
def permuting_unused_columns_costs_nothing(spark, d):
    rows, model = _forest(spark, d)

    def accuracy(scored):
        return evaluation.confusion(scored, "predicted", "half", "late", 12).first()["accuracy"]

    out = evaluation.permutation_importance(rows, list(DECIDED.numeric), model.score, accuracy, 42, [*LINE_KEY, "l_quantity", "l_tax"])
    return out.select("variable", F.when(F.col("variable") != "l_linenumber", F.round("raw", 6)).alias("raw"), "importance")


@query("SELECT 'mtry=3' AS candidate, fold, 1.0::DOUBLE AS auc FROM (VALUES (0), (1)) AS t(fold)")
def cross_validation_of_a_threshold(spark, d):
    """Every fold is tried with every candidate, and the threshold leaves nothing to get wrong."""
    return _forest(spark, d)[1].cv.withColumn("auc", F.round("auc", 6))


@query("SELECT 'l_quantity' AS term, 'increases' AS direction, '***' AS stars")
def the_cause_is_significant(spark, d):
    """At a level that chance does not reach, the quantity alone is left."""
    coefs = models.logit_coefficients(modelling.caused(spark, d), modelling.CAUSED, digits=None)
    found = evaluation.significant_terms(coefs, level=1e-6)
    return found.join(coefs.select("term", "stars"), "term").select("term", "direction", "stars")
