"""Supervised models: forests and logistic regression with cross-validation, down-sampled inside each fold.

All forests of a cross-validation (folds x candidates) grow in one job over the same packed rows; see `forest`.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padronix.functions.text import row_hash
from padronix.operators import forest as trees
from padronix.operators.correlation import aliased_positions
from padronix.operators.evaluation import auc, coef_table, confusion, scaled_importance
from padronix.operators.features import Scaling, design, design_names, fit_scaling
from padronix.operators.quality import require_two_classes
from padronix.operators.sampling import assign_folds, downsample, hash_cutoffs  # noqa: F401 (downsample: what cutoffs are compared with)
from padronix.operators.shared import shared_folder, written
from padronix.operators.sizing import fuller, join_table
from padronix.operators.threads import side_by_side

LABEL = "_label"
ORDER = "_order"  # the rows' random order, hashed once


@dataclass(frozen=True)
class Spec:
    """What to fit: label and its positive class, predictors, row key, and resampling choices.

    `forest` takes numTrees, maxDepth (30 by default, 60 at most) and maxBins (32 by default, 256 at most).
    """

    label: str
    positive: str
    categorical: Sequence[str] = ()
    numeric: Sequence[str] = ()
    key: Sequence[str] = ()
    folds: int = 5
    down: bool = True
    scale: bool = False
    seed: int = 42
    parallelism: int = 3
    forest: Mapping[str, int] = field(default_factory=lambda: {"numTrees": 300, "maxDepth": 30})
    mtry: Sequence[int] = (3, 5, 7)


@dataclass(frozen=True)
class Forest:
    """The trees of a fitted forest as a written table, the edges of their bins, and the packed rows they grew from."""

    edges: list[list[float]]
    growth: trees.Growth
    pieces: DataFrame
    chunks: DataFrame | None  # a loaded model has none


@dataclass(frozen=True)
class Fitted:
    """A trained model with everything scoring needs, its cross-validation table and its training time."""

    spec: Spec
    pipeline: PipelineModel
    scaling: Scaling | None
    negative: str
    names: list[str]
    cv: DataFrame
    seconds: float
    forest: Forest | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add `score` (probability of the positive class) and `predicted` (its class label).

        A forest's scores are computed when this is called, once per distinct binned row.
        """
        if self.forest is None:
            return _score(self.pipeline, _scaled(self.scaling, df), self.spec.positive, self.negative)
        return _score_forest(self, df)


def _with_label(df: DataFrame, spec: Spec) -> DataFrame:
    return df.withColumn(LABEL, (F.col(spec.label) == spec.positive).cast("double"))


def _scaled(scaling: Scaling | None, df: DataFrame) -> DataFrame:
    return df if scaling is None else scaling.apply(df)


def _score(model: Transformer, df: DataFrame, positive: str, negative: str) -> DataFrame:
    out = model.transform(df)
    out = out.withColumn("score", vector_to_array("probability")[1])
    said = F.when(F.col("prediction") == 1.0, positive).otherwise(negative)
    drop = [c for c in out.columns if c.endswith(("__i", "__d"))]
    return out.withColumn("predicted", said).drop("rawPrediction", "probability", "prediction", "features", "kept", *drop)


def _score_forest(model: Fitted, df: DataFrame) -> DataFrame:
    f = model.forest
    coded = model.pipeline.transform(_scaled(model.scaling, df)).withColumn("_bins", trees.binned("features", f.edges))
    kept = coded.select(*df.columns, "_bins")
    votes = trees.scores(kept.select(F.col("_bins").alias("bins")), f.pieces, f.growth.trees, shared_folder(df.sparkSession))
    out = join_table(kept, votes.withColumnRenamed("bins", "_bins"), ["_bins"]).drop("_bins")
    return out.withColumn("predicted", F.when(F.col("score") > 0.5, model.spec.positive).otherwise(model.negative))


def fold_cutoffs(folded: DataFrame, folds: int) -> dict[tuple[int, float], str]:
    """(fold left out, class) -> the largest hash that its balanced training part keeps, found for all folds at once.

    Folds are runs of ranks of a class's hashes, so the t-th smallest hash outside a fold has a rank in the whole
    class that follows from the folds' sizes: one search finds all of them.
    """
    sizes = {(r["fold"], r[LABEL]): r["count"] for r in folded.groupBy("fold", LABEL).count().collect()}
    classes = sorted({c for _, c in sizes})
    ranks: dict[tuple[int, float], int] = {}
    for f in range(folds):
        kept = min(sum(sizes.get((g, c), 0) for g in range(folds) if g != f) for c in classes)
        for c in classes:
            before = sum(sizes.get((g, c), 0) for g in range(f))
            ranks[f, c] = kept if kept <= before else kept + sizes.get((f, c), 0)
    wanted = F.create_map(
        *[x for c in classes for x in (F.lit(c), F.array(*[F.lit(r).cast("long") for r in sorted({ranks[f, c] for f in range(folds)})]))]
    )
    found = hash_cutoffs(folded.withColumn("_h", F.col(ORDER)), [LABEL], lambda n: F.element_at(wanted, F.col(LABEL))).collect()
    hash_of = {(r[LABEL], one["t"]): one["h"] for r in found for one in r["_cut"]}
    return {(f, c): hash_of[c, r] for (f, c), r in ranks.items() if r}


def _inside(folded: DataFrame, spec: Spec) -> dict[int, Column]:
    """Per split (folds, and last the final fit) the condition on `fold`, class and order that its training rows meet."""
    inside = {split: F.lit(True) for split in range(spec.folds + 1)}
    if spec.down:
        cuts = fold_cutoffs(folded, spec.folds)
        last = hash_cutoffs(folded.withColumn("_h", F.col(ORDER)), [LABEL], lambda n: F.array(n.cast("long")), of_smallest=True)
        cuts |= {(spec.folds, r[LABEL]): r["_cut"][0]["h"] for r in last.collect()}
        for split in inside:
            of_class = [(F.col(LABEL) == c) & (F.col(ORDER) <= largest) for (f, c), largest in cuts.items() if f == split]
            inside[split] = reduce(lambda x, y: x | y, of_class, F.lit(False))
    return {split: kept & (F.col("fold") != split) for split, kept in inside.items()}


def _splits(df: DataFrame, spec: Spec) -> tuple[DataFrame, list[int]]:
    """(persisted rows with `fold` and a flag `in<split>` per training part in place of their order, the size of each part).

    One table serves every split: flags take a byte a row, where a kept copy of each part takes all of its vectors again.
    """
    folded = assign_folds(df, LABEL, spec.folds, spec.seed, spec.key, order=ORDER)
    inside = _inside(folded, spec)
    flags = [kept.alias(f"in{split}") for split, kept in inside.items()]
    rows = folded.select(*[c for c in df.columns if c != ORDER], "fold", *flags).persist()
    sizes = rows.agg(*[F.count_if(f"in{split}") for split in inside]).first()
    return rows, list(sizes)


def _bare(model, spark: SparkSession):
    """A logit without its training summary. That holds the session, and a session that has watched a write (as `published` does)
    cannot be sent with a task that scores."""
    model._java_obj.setSummary(spark._jvm.scala.Option.apply(None))
    return model


def cross_validate(rows: DataFrame, sizes: Sequence[int], spec: Spec, candidates: Mapping[str, object]) -> list[tuple[str, int, float]]:
    """AUC per (candidate, fold), from the rows and sizes that `_splits` gives. Only the training part of a fold is down-sampled.

    `spec.parallelism` folds are fitted side by side. A fit keeps its rows in blocks of its own, so a part is not persisted.
    """
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")

    def run(fold: int) -> list[tuple[str, int, float]]:
        packed = fuller(rows.where(f"in{fold}"), n=sizes[fold])
        test = rows.where(F.col("fold") == fold)
        return [(n, fold, float(evaluator.evaluate(_bare(e.fit(packed), rows.sparkSession).transform(test)))) for n, e in candidates.items()]

    done = side_by_side(rows.sparkSession, run, range(spec.folds), min(spec.parallelism, spec.folds))
    return [trial for trials in done for trial in trials]


def _prepare(train: DataFrame, spec: Spec, numeric: Sequence[str]):
    need = dict.fromkeys([spec.label, *spec.categorical, *numeric, *spec.key])
    base = _with_label(train.select(*need), spec).persist()
    require_two_classes(base, LABEL)
    others = base.where(F.col(LABEL) == 0.0).select(F.col(spec.label).cast("string")).distinct().limit(2).collect()
    negative = others[0][0] if len(others) == 1 else f"not {spec.positive}"  # several other classes have no one name
    scaling = fit_scaling(base, numeric) if spec.scale and numeric else None
    rows = _scaled(scaling, base)
    coder = design(spec.categorical, numeric).fit(rows)
    names = design_names(coder, spec.categorical, numeric)
    rows = coder.transform(rows).select(LABEL, "features", row_hash(spec.seed + 1, *spec.key).alias(ORDER)).persist()
    rows.count()
    base.unpersist()
    return coder, names, scaling, negative, rows


def _finish(spec: Spec, train: DataFrame, candidates: Mapping[str, object], stages, names, scaling, negative, rows, source) -> Fitted:
    """Cross-validate and fit on `rows`; `source` is the persisted table that they come from, not needed once they are split."""
    started = time.monotonic()
    try:
        split, sizes = _splits(rows, spec)
    finally:
        source.unpersist()
    try:
        trials = cross_validate(split, sizes, spec, candidates)
        mean = {n: sum(a for m, _, a in trials if m == n) / spec.folds for n in candidates}
        best = max(candidates, key=lambda n: mean[n])
        final = _bare(candidates[best].fit(fuller(split.where(f"in{spec.folds}"), n=sizes[spec.folds])), train.sparkSession)
    finally:
        split.unpersist()
    cv = train.sparkSession.createDataFrame(trials, "candidate string, fold int, auc double")
    return Fitted(spec, PipelineModel([*stages, final]), scaling, negative, names, cv, time.monotonic() - started)


def _parts(rows: DataFrame, spec: Spec) -> DataFrame:
    """`rows` with `part`: a bit for every split that a row trains (folds, and last the final fit), and one for the fold it is held out in."""
    folded = assign_folds(rows, LABEL, spec.folds, spec.seed, spec.key, order=ORDER).persist()
    bits = F.call_function("shiftleft", F.lit(1), F.col("fold").cast("int") + trees.HELD)
    for split, kept in _inside(folded, spec).items():
        bits = bits + F.when(kept, 1 << split).otherwise(0)
    return folded.withColumn("part", bits)


def fit_forest(train: DataFrame, spec: Spec) -> Fitted:
    """Random forest with the number of tried predictors chosen by cross-validated AUC."""
    if spec.folds > 14:
        raise ValueError("a forest takes up to 14 folds")
    coder, names, scaling, negative, rows = _prepare(train, spec, spec.numeric)
    spark, started = train.sparkSession, time.monotonic()
    folder = shared_folder(spark)
    options = {"maxDepth": 30, "maxBins": 32} | dict(spec.forest)
    edges = trees.fit_bins(rows, "features", len(names), options["maxBins"])
    parted = _parts(rows.select(LABEL, ORDER, trees.binned("features", edges).alias("bins")), spec)
    packed = parted.select(F.xxhash64(ORDER).alias("id"), F.col(LABEL).cast("int").alias("y"), "part", "bins")
    chunks = written(trees.pack(packed), f"{folder}/chunks", large_rows=True)
    splits = range(spec.folds + 1)
    *counted, total = parted.agg(*[F.count_if(F.col("part").bitwiseAND(1 << s) > 0) for s in splits], F.count(F.lit(1))).first()
    parted.unpersist()
    rows.unpersist()

    def growth(split: int, mtry: int, keep: bool = False) -> trees.Growth:
        return trees.Growth(split, mtry, options["numTrees"], options["maxDepth"], spec.seed, options["maxBins"], keep)

    tries = sorted({min(m, len(names)) for m in spec.mtry})
    grown = [growth(f, m) for m in tries for f in range(spec.folds)]
    few = trees.count_groups(chunks, grown) <= min(trees.GROUPS, total // trees.GROUP_ROWS)
    if few:
        votes = trees.grow_groups(chunks, grown, len(names), f"{folder}/folds")
        scored = trees.held_out_group_scores(votes, chunks, grown, len(names)).persist()
    else:
        votes = trees.grow_forests(chunks, grown, [counted[g.split] for g in grown], len(names), f"{folder}/folds")
        scored = trees.held_out_scores(votes).persist()
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", metricName="areaUnderROC")

    def measured(i: int) -> tuple[str, int, float]:
        return f"mtry={grown[i].mtry}", grown[i].split, float(evaluator.evaluate(scored.where(F.col("fit") == i)))

    trials = side_by_side(spark, measured, range(len(grown)), spec.parallelism)
    scored.unpersist()
    mean = {m: sum(a for n, _, a in trials if n == f"mtry={m}") / spec.folds for m in tries}
    best = growth(spec.folds, max(tries, key=lambda m: mean[m]), keep=True)
    if few:
        final = trees.grow_groups(chunks, [best], len(names), f"{folder}/final")
    else:
        final = trees.grow_forests(chunks, [best], [counted[spec.folds]], len(names), f"{folder}/final")
    pieces = final.where("heap IS NOT NULL").select("tree", "heap", "feature", "cut", "share", "gains")
    cv = spark.createDataFrame(trials, "candidate string, fold int, auc double")
    forest = Forest(edges, best, pieces, chunks)
    return Fitted(spec, PipelineModel(coder.stages), scaling, negative, names, cv, time.monotonic() - started, forest)


def fit_logit(train: DataFrame, spec: Spec) -> Fitted:
    """Unpenalised logistic regression for scoring; terms that are linear functions of earlier ones are left out."""
    coder, names, scaling, negative, rows = _prepare(train, spec, spec.numeric)
    slicer, kept = _without_aliases(rows, names)
    sliced = slicer.transform(rows).drop("features")
    candidates = {"logit": LogisticRegression(labelCol=LABEL, featuresCol="kept", regParam=0.0, maxIter=100)}
    return _finish(spec, train, candidates, [*coder.stages, slicer], kept, scaling, negative, sliced, rows)


def _without_aliases(rows: DataFrame, names: Sequence[str]) -> tuple[VectorSlicer, list[str]]:
    dropped = set(aliased_positions(rows, "features"))
    kept = [i for i in range(len(names)) if i not in dropped]
    return VectorSlicer(inputCol="features", outputCol="kept", indices=kept), [names[i] for i in kept]


def logit_coefficients(train: DataFrame, spec: Spec, digits: int | None = 4) -> DataFrame:
    """Coefficient table with standard errors: the log-odds of the positive class; digits None leaves it unrounded.

    A term that is a linear function of the earlier ones is left out before fitting. Importance and significance
    are to be taken from unrounded tables.
    """
    _, names, _, _, rows = _prepare(train, spec, spec.numeric)
    try:
        slicer, kept = _without_aliases(rows, names)
        sliced = slicer.transform(rows)
        glr = GeneralizedLinearRegression(
            labelCol=LABEL, featuresCol="kept", family="binomial", link="logit", maxIter=50
        )
        model = glr.fit(sliced)
        summary = model.summary
        estimates = [*model.coefficients.toArray(), model.intercept]
        labels = [*kept, "(Intercept)"]
        terms = list(
            zip(
                labels,
                map(float, estimates),
                map(float, summary.coefficientStandardErrors),
                map(float, summary.tValues),
                map(float, summary.pValues),
            )
        )
    finally:
        rows.unpersist()
    return coef_table(train.sparkSession, terms, digits)


def impurity_importance(model: Fitted) -> DataFrame:
    """Mean fall of impurity per term of a forest, rescaled to 0..100."""
    found = trees.impurity(model.forest.pieces, len(model.names))
    return scaled_importance(model.cv.sparkSession.createDataFrame(list(zip(model.names, found, strict=True)), "variable string, raw double"))


def out_of_bag_importance(model: Fitted) -> DataFrame:
    """Mean loss of accuracy on the rows outside each tree's bag when a term is shuffled among them, rescaled to 0..100."""
    f = model.forest
    if f.chunks is None:
        raise ValueError("a loaded model has no rows outside its bags")
    lost = {r["feature"]: r["loss"] for r in trees.outside_bags(f.chunks, f.pieces, f.growth).collect()}
    rows = [(n, float(lost.get(i, 0.0))) for i, n in enumerate(model.names)]
    return scaled_importance(model.cv.sparkSession.createDataFrame(rows, "variable string, raw double"))


def z_importance(coefs: DataFrame) -> DataFrame:
    """|z| of each term, rescaled to 0..100."""
    rows = coefs.where(F.col("term") != "(Intercept)")
    return scaled_importance(rows.select(F.col("term").alias("variable"), F.abs("z").alias("raw")))


def evaluate(model: Fitted, test: DataFrame, name: str) -> DataFrame:
    """One metrics row on a test table: accuracy, sensitivity, specificity, precision, F1, AUC, seconds."""
    spec = model.spec
    scored = model.score(test).select("predicted", "score", spec.label).persist()
    table = confusion(scored, "predicted", spec.label, spec.positive).withColumn(
        "auc", auc(scored, "score", spec.label, spec.positive).select("auc").scalar()
    )
    row = table.select(
        F.lit(name).alias("model"),
        "accuracy",
        "sensitivity",
        "specificity",
        "precision",
        "f1",
        "balanced_accuracy",
        "auc",
        F.lit(round(model.seconds, 3)).alias("seconds"),
    )
    pinned = test.sparkSession.createDataFrame(row.toArrow(), schema=row.schema)
    scored.unpersist()
    return pinned


def save_model(model: Fitted, path: str) -> None:
    """Write all that scoring needs: the fitted stages, the scaling before them, the classes, the specification."""
    spark = model.cv.sparkSession
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    scaling = None if model.scaling is None else {"mean": model.scaling.mean, "sd": model.scaling.sd}
    about = {
        "spec": asdict(model.spec) | {"forest": dict(model.spec.forest)}, "scaling": scaling, "negative": model.negative,
        "names": model.names, "seconds": model.seconds,
    }
    if model.forest is not None:
        about["forest"] = {"edges": model.forest.edges, "growth": asdict(model.forest.growth)}
        model.forest.pieces.write.mode("overwrite").parquet(f"{path}/trees")
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    model.cv.write.mode("overwrite").parquet(f"{path}/cv")


def load_model(spark: SparkSession, path: str) -> Fitted:
    """A saved model, which scores as it did before saving."""
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    spec = Spec(**{k: tuple(v) if isinstance(v, list) else v for k, v in about["spec"].items()})
    scaling = about["scaling"] and Scaling(about["scaling"]["mean"], about["scaling"]["sd"])
    pipeline = PipelineModel.load(f"{path}/pipeline")
    forest = None
    if "forest" in about:
        forest = Forest(about["forest"]["edges"], trees.Growth(**about["forest"]["growth"]), spark.read.parquet(f"{path}/trees"), None)
    return Fitted(spec, pipeline, scaling, about["negative"], about["names"], spark.read.parquet(f"{path}/cv"), about["seconds"], forest)
