"""Every result table of a run over the integrated registry, written as reports, and the models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.operators import evaluation, models, stats
from padronix.plans import explore, hypotheses
from padronix.operators.models import Spec
from padronix.sources.files import write_report

# What each algorithm is, where it is applied, and why.
ALGORITHMS = (
    ("Random Forest", "Supervised", "H1: exporter, H3: health sector", "Interactions of mixed predictors, importance"),
    ("Logistic Regression", "Supervised", "H2: women's share by area, comparison", "Odds and significance of each term"),
    ("K-means", "Unsupervised", "Sector clusters", "Groups of sectors without a label"),
)


def algorithms(spark) -> DataFrame:
    return spark.createDataFrame(list(ALGORITHMS), "algorithm string, kind string, application string, reason string")


def with_insight(table: DataFrame) -> DataFrame:
    """The hypothesis table with a sentence that states the main result."""
    said = F.concat(F.lit("The model of "), "hypothesis", F.lit(" is "), "verdict", F.lit(" ("), "main_metric", F.lit(")"))
    return table.withColumn("insight", said)


def write_results(
    full: DataFrame, folder: str, min_sector: int = 1000, min_area: int = 50, k: int = 3, nstart: int = 25,
    exporter: Spec = hypotheses.EXPORTER, geography: Spec = hypotheses.GEOGRAPHY, health: Spec = hypotheses.HEALTH,
    gender: Spec = hypotheses.GENDER,
) -> None:
    """Explore, cluster, fit and compare, and write each table under `folder`/reports, each model under `folder`/models.

    `full` should be a written table, as it is passed over many times.
    """

    def report(name: str, table: DataFrame) -> None:
        write_report(table, f"{folder}/reports/{name}")

    report("sector_profile", explore.sector_profile(full, min_sector))
    assigned, prepared, _ = explore.cluster_sectors(explore.sector_features(full, min_sector), k, nstart)
    scaled = [f"z_{c}" for c in prepared.cols]
    report("sector_clusters", assigned.drop("features", *scaled))
    report("cluster_profile", explore.cluster_report(assigned))
    prepared.table.unpersist()
    report("executive_summary", explore.executive_summary(full))
    report("insights", explore.key_insights(full))

    outcomes = {
        "H1": hypotheses.run(hypotheses.exporter_data(full), exporter, "Random Forest"),
        "H2": hypotheses.run(hypotheses.geography_data(full, min_area), geography, "Logistic Regression", "logit"),
        "H3": hypotheses.run(hypotheses.health_data(full), health, "Random Forest"),
    }
    report("hypotheses", with_insight(hypotheses.hypothesis_table({n: o.metrics for n, o in outcomes.items()})))
    report("algorithms", algorithms(full.sparkSession))
    rows = hypotheses.gender_data(full).persist()
    compared = hypotheses.compare(rows, gender, replace(gender, scale=True))
    report("model_comparison", compared)
    report("classification_summary", evaluation.classification_summary(rows, compared.limit(1), stats.baseline(rows, gender.label)))
    rows.unpersist()
    for name, outcome in outcomes.items():
        models.save_model(outcome.model, f"{folder}/models/{name}")
        outcome.release()
