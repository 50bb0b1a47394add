"""Misspelled names matched to a table of known names by edit distance, without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padronix.operators.sizing import join_table


def _known_keys(name: Column, distance: int) -> Column:
    """A known name cut into `distance` + 1 segments: one of them stays whole in any spelling within `distance` edits."""
    size = F.length(name)
    parts = distance + 1
    keys = []
    for i in range(parts):
        start = F.floor(size * i / parts).cast("int")
        end = F.floor(size * (i + 1) / parts).cast("int")
        keys.append(F.struct(size.alias("size"), F.lit(i).alias("part"), F.substring(name, start + 1, end - start).alias("text")))
    return F.array(*keys)


def _spelling_keys(name: Column, distance: int) -> Column:
    """For every length a known name may have, its segments as read from the spelling, moved by up to `distance`."""
    parts = distance + 1
    keys = []
    for longer in range(-distance, distance + 1):
        size = F.length(name) + longer
        for i in range(parts):
            start = F.floor(size * i / parts).cast("int")
            end = F.floor(size * (i + 1) / parts).cast("int")
            for moved in range(-distance, distance + 1):
                fits = (size >= 0) & (start + moved >= 0) & (end + moved <= F.length(name))
                read = F.substring(name, start + moved + 1, end - start)
                keys.append(F.when(fits, F.struct(size.alias("size"), F.lit(i).alias("part"), read.alias("text"))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def match_names(
    df: DataFrame, column: str, known: DataFrame, name: str, max_distance: int = 2, fold=lambda c: c
) -> DataFrame:
    """Every spelling in `column` with the nearest known name within `max_distance` edits.

    Columns: `column`, n (rows), match, distance, n_ties (known names at that distance). `fold` is applied to
    both sides before they are compared (case, accents, blanks). If several names are equally near, match is
    null and n_ties says how many there are; without a name in reach, match and distance are null and n_ties is 0.
    Null spellings are left out. Distinct spellings only are compared, with the names that share a segment.
    """
    # aggregated before the names are folded, so a frequent spelling is one row
    seen = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_seen")).agg(F.count(F.lit(1)).alias("n"))
    seen = seen.withColumn("_s", fold(F.col("_seen")))
    names = known.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct().withColumn("_k", fold(F.col("_name")))
    spelled = seen.select("_s").distinct().select("_s", F.explode(_spelling_keys(F.col("_s"), max_distance)).alias("_key"))
    targets = names.select("_name", "_k", F.explode(_known_keys(F.col("_k"), max_distance)).alias("_key"))
    pairs = spelled.join(targets, "_key").select("_s", "_k", "_name").distinct()
    near = pairs.withColumn("distance", F.levenshtein("_s", "_k", max_distance)).where("distance >= 0")
    ranked = near.groupBy("_s", "distance").agg(F.count(F.lit(1)).alias("n_ties"), F.min("_name").alias("_name"))
    best = ranked.groupBy("_s").agg(F.min(F.struct("distance", "n_ties", "_name")).alias("_b"))
    return seen.join(best, "_s", "left").select(
        F.col("_seen").alias(column),
        "n",
        F.when(F.col("_b.n_ties") == 1, F.col("_b._name")).alias("match"),
        F.col("_b.distance").alias("distance"),
        F.coalesce("_b.n_ties", F.lit(0)).cast("bigint").alias("n_ties"),
    )


def repair_names(df: DataFrame, column: str, matches: DataFrame) -> DataFrame:
    """`df` with every spelling that `match_names` could settle replaced by the known name; other values stay."""
    found = matches.where("match IS NOT NULL").select(column, F.col("match").alias("_match"))
    return join_table(df, found, [column], "left").withColumn(column, F.coalesce("_match", column)).drop("_match").select(*df.columns)


def unsettled_names(matches: DataFrame) -> DataFrame:
    """Spellings without one nearest name, with their rows."""
    return matches.where("match IS NULL")
