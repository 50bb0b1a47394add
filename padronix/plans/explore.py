"""Exploratory analysis of the integrated registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.functions.values import three_way
from padronix.operators import clustering, correlation, distribution, sampling, stats
from padronix.plans.registry import GENDER_CLASSES

NUMERIC = ["share_women", "size_mid", "export_quintile", "lat", "lon"]
SECTOR_INPUT = ["section", "section_name", "share_women", "size_mid", "export_quintile", "size_class", "province"]
SECTOR_COLUMNS = ["n", "mean_share", "median_share", "mean_size", "export_rate", "small_share", "areas"]
EXECUTIVE = {"regions": "region", "provinces": "province", "sectors": "section_name"}
ROW_KEY = ["owner_id", "branch", "year"]


def frequencies(full: DataFrame) -> dict[str, DataFrame]:
    composed = full.withColumn(
        "composition", three_way(F.col("share_women"), 0.3, 0.7, GENDER_CLASSES, upper_closed=True)
    )
    columns = ["region", "province", "size_class", "export_class", "composition"]
    return {c: stats.freq(composed, c) for c in columns}


def sector_profile(full: DataFrame, min_n: int = 1000) -> DataFrame:
    return stats.group_profile(full, "section_name", "share_women", min_n)


def sector_extremes(full: DataFrame, min_n: int = 1000) -> DataFrame:
    overall = full.agg(F.avg("share_women").alias("m")).scalar()
    return stats.extremes(sector_profile(full, min_n), "section_name", "mean", overall)


def correlations(full: DataFrame) -> DataFrame:
    return correlation.corr_matrix(full, NUMERIC)


def pairs_panel(full: DataFrame, cols=("share_women", "size_mid", "export_quintile"), n: int = 10_000, seed: int = 42):
    """Correlations and densities of a few variables on a fixed-size sample."""
    sample = sampling.sample_n(full, n, seed, ROW_KEY).persist()
    return correlation.corr_matrix(sample, list(cols)), {c: distribution.density(sample, c) for c in cols}


def sector_features(full: DataFrame, min_n: int = 1000) -> DataFrame:
    return clustering.group_features(
        full,
        ["section", "section_name"],
        "share_women",
        "size_mid",
        F.col("export_quintile") > 0,
        F.col("size_class") == "Pequeña",
        "province",
        min_n,
    )


def cluster_sectors(groups: DataFrame, k: int = 3, nstart: int = 25, seed: int = 42, cols=tuple(SECTOR_COLUMNS)):
    """Assigned sectors, the prepared table and the best model."""
    prepared = clustering.prepare(groups, cols)
    prepared = clustering.Prepared(prepared.table.persist(), prepared.cols, prepared.scaling)
    model = clustering.kmeans_best(prepared.table, k, nstart, seed)
    return model.transform(prepared.table).withColumnRenamed("prediction", "cluster"), prepared, model


CLUSTER_MEANS = {"mean_share": 3, "export_rate": 3, "mean_size": 1, "small_share": 1}


def cluster_report(assigned: DataFrame) -> DataFrame:
    """Profile per cluster with the true median of the sector means."""
    profile = clustering.cluster_profile(assigned, "cluster", CLUSTER_MEANS)
    return profile.join(clustering.cluster_median(assigned, "cluster", "mean_share"), "cluster")


def executive_summary(full: DataFrame) -> DataFrame:
    return stats.executive_summary(full, EXECUTIVE, "share_women", F.col("is_exporter"), "size_mid")


def key_insights(full: DataFrame) -> DataFrame:
    return stats.insights(full, "region", "section_name", "share_women", F.col("is_exporter"))
