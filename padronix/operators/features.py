"""Feature preparation. Fitted quantities are one-row aggregates turned into literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padronix.operators.quantiles import quantiles


def flags(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """0/1 columns from conditions; an unknown condition gives NULL."""
    return df.withColumns({name: cond.cast("int") for name, cond in spec.items()})


def two_levels(condition: Column, yes: str, no: str) -> Column:
    """Label for a condition, NULL where it is unknown."""
    return F.when(condition, yes).when(~condition, no)


def target_at(c: Column, cut: float, high: str = "Alta", low: str = "Baja") -> Column:
    """High label at or above the cut."""
    return two_levels(c >= cut, high, low)


def median_split(df: DataFrame, x: str, name: str, high: str = "Alta", low: str = "Baja") -> DataFrame:
    """High label strictly above the median of x."""
    middle = quantiles(df, x, [0.5]).scalar()
    return df.withColumn("_m", middle).withColumn(name, two_levels(F.col(x) > F.col("_m"), high, low)).drop("_m")


@dataclass(frozen=True)
class Scaling:
    """Means and sample standard deviations of a training table."""

    mean: Mapping[str, float]
    sd: Mapping[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        """Centre and scale; a constant column is centred only."""
        return df.withColumns(
            {c: (F.col(c) - self.mean[c]) / (self.sd[c] if self.sd[c] else 1.0) for c in self.mean}
        )


def fit_scaling(df: DataFrame, cols: Sequence[str]) -> Scaling:
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    mean = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(cols)}
    return Scaling(mean, {c: row[f"s{i}"] or 0.0 for i, c in enumerate(cols)})


def standardize(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Scale both tables by the training table's mean and sd."""
    scaling = fit_scaling(train, cols)
    return scaling.apply(train), scaling.apply(test)


def varying(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns whose standard deviation is above zero."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > 0]


def drop_constant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    keep = set(varying(df, cols))
    return df.drop(*[c for c in cols if c not in keep])


def design(categorical: Sequence[str], numeric: Sequence[str], output: str = "features") -> Pipeline:
    """Dummy coding with the alphabetically first level as reference, then one vector."""
    stages = []
    if categorical:
        index = [f"{c}__i" for c in categorical]
        dummy = [f"{c}__d" for c in categorical]
        stages = [
            StringIndexer(inputCols=list(categorical), outputCols=index, stringOrderType="alphabetDesc"),
            OneHotEncoder(inputCols=index, outputCols=dummy, dropLast=True),
        ]
        stages.append(VectorAssembler(inputCols=[*dummy, *numeric], outputCol=output))
    else:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol=output))
    return Pipeline(stages=stages)


def design_names(fitted, categorical: Sequence[str], numeric: Sequence[str]) -> list[str]:
    """Term names in the order of the design vector."""
    names = []
    if categorical:
        for c, labels in zip(categorical, fitted.stages[0].labelsArray):
            names += [f"{c}={level}" for level in labels[:-1]]
    return [*names, *numeric]
