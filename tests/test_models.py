"""Fitted models on small tables with a known answer."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from padronix.operators import models
from padronix.operators.correlation import aliased_columns, corr_matrix, corr_rank, principal_components
from padronix.operators.features import design, design_names, drop_constant, median_split, standardize, target_at
from padronix.operators.quality import level_counts, require_two_classes
from padronix.plans import hypotheses


@pytest.fixture(scope="module")
def data(spark):
    u = F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10_000.0
    w = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10_000)) / 10_000.0
    df = spark.range(3000).select(
        "id", (u * 4 - 2).alias("x"), (F.pmod(F.col("id"), F.lit(3))).alias("g"), w.alias("w"),
    )
    df = df.withColumn("kind", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("g") + 1).cast("int")))
    logit = 0.5 + 1.5 * F.col("x") - F.when(F.col("kind") == "c", 1.0).otherwise(0.0)
    return df.withColumn("y", F.when(F.col("w") < 1 / (1 + F.exp(-logit)), "yes").otherwise("no")).withColumn("x2", 2 * F.col("x") + 1).drop("w").cache()


SPEC = models.Spec(
    label="y", positive="yes", categorical=("kind",), numeric=("x", "x2"), key=("id",), folds=3,
    forest={"numTrees": 10, "maxDepth": 4}, mtry=(1, 2),
)


def test_coefficients_recover_the_truth_without_the_aliased_column(data):
    rows = {r.term: r for r in models.logit_coefficients(data, SPEC).collect()}
    assert set(rows) == {"x", "kind=b", "kind=c", "(Intercept)"}
    assert rows["x"].estimate == pytest.approx(1.5, abs=0.2)
    assert rows["kind=c"].estimate == pytest.approx(-1.0, abs=0.3)
    assert rows["x"].stars == "***" and rows["x"].odds_ratio == pytest.approx(math.exp(rows["x"].estimate), rel=1e-3)
    top = models.z_importance(models.logit_coefficients(data, SPEC)).first()
    assert top.variable == "x" and top.importance == 100


def test_logit_and_forest(data, tmp_path):
    train, test = hypotheses.split(data, SPEC)
    assert (train.count() + test.count()) == 3000
    logit = models.fit_logit(train, SPEC)
    row = models.evaluate(logit, test, "logit").first()
    assert row.auc > 0.8 and 0.6 < row.accuracy < 1 and row.seconds > 0
    assert logit.cv.count() == 3 and "x2" not in logit.names
    forest = models.fit_forest(train, SPEC)
    assert models.evaluate(forest, test, "forest").first().auc > 0.75
    assert forest.cv.count() == 6
    assert models.impurity_importance(forest).count() == 4
    models.save_model(forest, str(tmp_path / "m"))
    again = models.load_model(test.sparkSession, str(tmp_path / "m"))
    one, two = (m.score(test).select("id", "score", "predicted") for m in (forest, again))
    assert one.exceptAll(two).count() == 0 and again.spec == SPEC
    assert {r.predicted for r in one.select("predicted").distinct().collect()} == {"yes", "no"}


def test_a_scaled_model_scores_alike_after_loading(data, tmp_path):
    model = models.fit_logit(data, replace(SPEC, scale=True))
    models.save_model(model, str(tmp_path / "s"))
    again = models.load_model(data.sparkSession, str(tmp_path / "s"))
    one, two = (m.score(data).select("id", "score") for m in (model, again))
    assert one.exceptAll(two).count() == 0 and again.scaling.mean == model.scaling.mean
    plain = models.fit_logit(data, SPEC).score(data).select("id", F.round("score", 4))
    assert one.select("id", F.round("score", 4)).exceptAll(plain).count() < 30


def test_factor_aliases_are_left_out_of_scoring_models(data):
    doubled = data.withColumn("kind2", F.concat(F.col("kind"), F.lit("_"))).drop("x2")
    model = models.fit_logit(doubled, replace(SPEC, categorical=("kind", "kind2"), numeric=("x",)))
    assert len(model.names) == 3 and model.score(doubled).where("score IS NULL").count() == 0


def test_fold_cutoffs_equal_down_sampling_of_each_training_part(data):
    rows = data.select(
        F.when(F.col("y") == "yes", 1.0).otherwise(0.0).alias(models.LABEL), F.md5(F.col("id").cast("string")).alias(models.ORDER)
    )
    folded = models.assign_folds(rows, models.LABEL, 4, 1, ["id"], order=models.ORDER).persist()
    cuts = models.fold_cutoffs(folded, 4)
    for f in range(4):
        part = folded.where(F.col("fold") != f)
        want = models.downsample(part, models.LABEL, 1, ["id"], order=models.ORDER)
        kept = F.when(F.col(models.LABEL) == 1.0, cuts[f, 1.0]).otherwise(cuts[f, 0.0])
        got = part.where(F.col(models.ORDER) <= kept)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() > 0
    folded.unpersist()


def test_compare_ranks_both_models(data):
    out = hypotheses.compare(data, SPEC, SPEC).collect()
    assert {r.model for r in out} == {"Regresion Logistica", "Random Forest"} and out[0].auc >= out[1].auc


def test_reference_level_is_the_first_in_the_alphabet(data):
    coder = design(["kind"], ["x"]).fit(data)
    assert design_names(coder, ["kind"], ["x"]) == ["kind=c", "kind=b", "x"]


def test_aliased_columns(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.lit(3.0).alias("k")
    ).withColumn("c", 2 * F.col("a") + 1).withColumn("d", F.col("a") - 3 * F.col("b"))
    assert aliased_columns(df, ["a", "b", "k", "c", "d"]) == ["k", "c", "d"]


def test_elimination_in_panels_equals_plain_elimination():
    import time

    import numpy as np
    from padronix.operators import correlation

    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 300))
    for j, of in ((40, (3, 5)), (130, (128, 129)), (200, (1, 199)), (299, (0, 150))):
        x[:, j] = x[:, of[0]] - 2 * x[:, of[1]]
    x[:, 77] = 4.0
    with np.errstate(invalid="ignore"):
        r = np.corrcoef(x, rowvar=False)
    assert correlation._dependent(r, x.var(axis=0), 1e-9) == [40, 77, 130, 200, 299]
    k = 3000
    wide = np.full((k, k), -1.0 / (k - 1))  # dummies of one factor, all levels: the last is a function of the others
    np.fill_diagonal(wide, 1.0)
    started = time.monotonic()
    assert correlation._dependent(wide, np.ones(k), 1e-9) == [k - 1] and time.monotonic() - started < 30


def test_correlations(spark):
    df = spark.range(20).select(F.col("id").alias("a"), (-F.col("id")).alias("b"), (F.col("id") % 4).alias("c"))
    r = {(x.var1, x.var2): x.r for x in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(r) == 9 and r[("a", "a")] == 1.0 and r[("a", "b")] == -1.0 and r[("b", "c")] == r[("c", "b")]
    assert [x.variable for x in corr_rank(df, "a", ["a", "b", "c"]).collect()] == ["b", "c"]


def test_components_explain_everything(data):
    variance, loadings = principal_components(data, ["x", "g"], 2)
    assert variance.orderBy("component").collect()[-1].cumulative == pytest.approx(1.0)
    assert loadings.count() == 4


def test_scaling_uses_training_rows_only(spark):
    train, test = spark.createDataFrame([(1.0,), (3.0,)], "x double"), spark.createDataFrame([(5.0,)], "x double")
    a, b = standardize(train, test, ["x"])
    assert [round(r.x, 6) for r in a.collect()] == [-0.707107, 0.707107] and round(b.first().x, 6) == 2.12132
    assert drop_constant(train.withColumn("k", F.lit(1)), ["x", "k"]).columns == ["x"]


def test_targets(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,), (None,), (0.9,)], "x double")
    assert [r[0] for r in df.select(target_at(F.col("x"), 0.5)).collect()] == ["Alta", "Baja", None, "Alta"]
    # the median itself is not above the median
    assert [r.t for r in median_split(df, "x", "t").collect()] == ["Baja", "Baja", None, "Alta"]


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError):
        require_two_classes(spark.createDataFrame([("a",), ("a",), (None,)], "y string"), "y")
    levels = {r.column: r.usable for r in level_counts(spark.createDataFrame([("a", 1), ("a", 2)], "y string, z int"), ["y", "z"]).collect()}
    assert levels == {"y": False, "z": True}


def test_opposite_foldings_of_the_size_classes(spark):
    rows = [(str(i), 1, 2021, c, "SALUD HUMANA", "Centro", 0.5, 5.0, 1, -34.0, -58.0) for i, c in enumerate(["Micro", "Pequeña", "Mediana", "Grande"])]
    full = spark.createDataFrame(
        rows, "owner_id string, branch int, year int, size_class string, section_name string, region string, share_women double, "
        "size_mid double, export_quintile int, lat double, lon double",
    )
    assert [r.small for r in hypotheses.exporter_data(full).orderBy("owner_id").collect()] == ["Micro", "Pequeña", "Micro", "Micro"]
    assert [r.size_simple for r in hypotheses.gender_data(full).orderBy("owner_id").collect()] == ["Micro", "Pequeña", "Pequeña", "Pequeña"]
    first = hypotheses.exporter_data(full).first()
    assert (first.exporter, first.health, first.central, first.high_women, first.north_zone, first.coast_zone) == (
        "Exportador", "Salud", "Centro", "Baja_Fem", "Sur", "Costera",
    )
    assert hypotheses.health_data(full).count() == 4


def test_registered_forests_try_all_candidates_in_all_folds_with_all_trees(spark):
    """What was fitted says what was asked for: trees, candidates, folds."""
    from padronix.plans.catalog import modelling

    spec = modelling.CAUSED
    model = models.fit_forest(modelling.caused(spark, "/root/testdata/sf0.001"), spec)
    assert model.forest.growth.trees == model.forest.pieces.select("tree").distinct().count() == 300
    assert model.forest.growth.depth == 30 and model.forest.growth.split == spec.folds == 5
    tries = {min(m, len(model.names)) for m in (3, 5, 7)}
    assert {(r.candidate, r.fold) for r in model.cv.collect()} == {(f"mtry={m}", f) for m in tries for f in range(5)}
    assert model.cv.where("auc < 0.8").count() == 0


def test_the_reduced_comparison_forest_has_six_predictors_and_a_hundred_trees():
    spec = hypotheses.GENDER_REDUCED
    assert len(spec.categorical) + len(spec.numeric) == 6 and spec.forest["numTrees"] == 100 and tuple(spec.mtry) == (2, 3)


def test_one_table_of_flags_holds_every_training_part(data):
    rows = data.select(
        F.when(F.col("y") == "yes", 1.0).otherwise(0.0).alias(models.LABEL), F.md5(F.col("id").cast("string")).alias(models.ORDER), "id"
    )
    spec = replace(SPEC, folds=3, seed=1, key=("id",))
    folded = models.assign_folds(rows, models.LABEL, 3, 1, ["id"], order=models.ORDER)
    for down in (True, False):
        split, sizes = models._splits(rows, replace(spec, down=down))
        for f in range(4):
            part = folded.where(F.col("fold") != f)
            want = models.downsample(part, models.LABEL, 1, ["id"], order=models.ORDER) if down else part
            got = [r.id for r in split.where(f"in{f}").collect()]
            assert sorted(got) == sorted(r.id for r in want.collect()) and len(got) == sizes[f] > 0
        assert models.ORDER not in split.columns
        split.unpersist()


def test_a_logit_keeps_one_table_while_it_is_validated(spark, data, monkeypatch):
    kept = []
    validate = models.cross_validate

    def watched(*args):
        kept.append(spark.sparkContext._jsc.getPersistentRDDs().size() - before)
        return validate(*args)

    monkeypatch.setattr(models, "cross_validate", watched)
    data.count()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    models.fit_logit(data, SPEC)
    assert kept == [1]


def test_a_session_that_has_watched_a_write_fits_and_scores_logits(spark):
    """Publishing watches its writes; after that no task took a logit ("Task not serializable")."""
    from pyspark.sql import Observation

    seen = Observation()
    df = spark.range(400).selectExpr("id", "cast(id % 10 as double) x", "if(id % 10 + id % 7 > 8, 'yes', 'no') y")
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 400
    model = models.fit_logit(df, models.Spec(label="y", positive="yes", numeric=("x",), key=("id",), folds=2))
    assert model.cv.count() == 2 and model.score(df).where("score > 0.5").count() > 0
