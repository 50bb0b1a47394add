"""Cleaning operators: recoding, typing, rules and keep-first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.functions.text import squish
from padronix.functions.values import finite_or, first_match, to_double, to_int


def squish_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: squish(F.col(c)) for c in cols})


def canonicalize(df: DataFrame, col: str, rules: Sequence[tuple[str, str]], lower: bool = False) -> DataFrame:
    """Replace known spellings (regular expression -> value), leaving other text unchanged.

    `lower` matches against the lower-cased text.
    """
    source = F.lower(F.col(col)) if lower else F.col(col)
    return df.withColumn(col, first_match(source, rules, otherwise=F.col(col)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns a contract names; unreadable text becomes NULL. Other columns stay.

    The typed columns pass through a one-element array: filters on them are then not rewritten in terms
    of the text, which would repeat every cast in every rule.
    """
    casts = {}
    for field in schema:
        if field.name not in df.columns:
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            casts[field.name] = to_int(c)
        elif isinstance(field.dataType, T.DoubleType):
            casts[field.name] = to_double(c)
        else:
            casts[field.name] = c.cast("string").try_cast(field.dataType)
    typed = df.withColumns(casts)
    return typed.select(F.inline(F.array(F.struct(*typed.columns))))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under an explicit order.

    The order must be total for a repeatable choice. Spark limits each key to one row before the
    shuffle (WindowGroupLimit), so a hot key does not gather in one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows for which every named rule is true; an unknown (NULL) rule rejects."""
    for rule in rules.values():
        df = df.where(rule)
    return df


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows failing each rule, and rows kept by all, in one pass."""
    everything = F.lit(True)
    for rule in rules.values():
        everything = everything & _holds(rule)
    items = [F.struct(F.lit(n).alias("rule"), F.count_if(~_holds(r)).alias("n_rejected")) for n, r in rules.items()]
    out = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(everything).alias("n_kept"), F.array(*items).alias("_items")
    )
    return out.select("n_rows", "n_kept", F.inline("_items")).select("rule", "n_rejected", "n_kept", "n_rows")


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def fill_nonfinite(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    return df.withColumns({c: finite_or(F.col(c).cast("double"), default) for c in cols})


def unmapped(df: DataFrame, source: str, target: str, fallback: str) -> DataFrame:
    """Source values that fell through a recoding, with their counts."""
    return df.where(F.col(target) == fallback).groupBy(source).agg(F.count(F.lit(1)).alias("n"))
