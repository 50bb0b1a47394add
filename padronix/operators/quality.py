"""Data-quality measurements. All of them report; none of them drops a row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.functions.values import equal_width_bin, is_missing, pct
from padronix.operators.wide_quantiles import wide_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def missing_in(field: T.StructField) -> Column:
    return is_missing(F.col(field.name), field.dataType.typeName())


def missing_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing values per column, by one pass over the table."""
    counts = [F.struct(F.lit(f.name).alias("column"), F.count_if(missing_in(f)).alias("n")) for f in df.schema]
    rows = df.agg(F.count(F.lit(1)).alias("_rows"), F.array(*counts).alias("_items"))
    out = rows.select("_rows", F.inline("_items")).select(
        "column", F.col("n").alias("n_missing"), pct(F.col("n"), F.col("_rows")).alias("pct_missing")
    )
    return out.where(F.col("n_missing") > 0) if only_missing else out


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each distinct row (or key), and their share.

    Copies meet in the map-side combine, so a mass of equal rows costs one shuffled row per task.
    """
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).select(
        "n_rows",
        "n_distinct",
        (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"),
        pct(F.col("n_rows") - F.col("n_distinct"), F.col("n_rows")).alias("pct_duplicates"),
    )


def _value_key(c: str) -> list[Column]:
    """Columns that are equal where values are: a long text is told by its length and a digest."""
    size = F.length(c)
    return [size.alias("_size"), F.when(size > 64, F.sha2(c, 256)).otherwise(F.col(c)).alias("_value")]


def profile_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per text column: missing, completeness, lengths, empty, distinct, blank.

    One wide aggregate, and one scan of each column alone for its distinct values.
    """
    texts = [F.col(c).cast("string") for c in cols]
    wide = df.agg(
        *[
            F.struct(
                F.count_if(t.isNull()).alias("n_missing"),
                F.round(F.avg(t.isNotNull().cast("double")), 4).alias("complete_rate"),
                F.min(F.length(t)).alias("min_length"),
                F.max(F.length(t)).alias("max_length"),
                F.count_if(t == "").alias("n_empty"),
                F.count_if(t.rlike(r"^\s+$")).alias("n_blank"),
            ).alias(f"_t{i}")
            for i, t in enumerate(texts)
        ]
    )
    rows = []
    for i, c in enumerate(cols):
        values = df.select(F.col(c).cast("string").alias("_text")).where(F.col("_text").isNotNull()).select(*_value_key("_text"))
        n_unique = values.distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
        names = ["n_missing", "complete_rate", "min_length", "max_length", "n_empty"]
        measures = [F.col(f"_t{i}")[n].alias(n) for n in names]
        rows.append(F.struct(F.lit(c).alias("column"), *measures, n_unique.alias("n_unique"), F.col(f"_t{i}")["n_blank"].alias("n_blank")))
    return wide.select(F.inline(F.array(*rows)))


def profile_numeric(df: DataFrame, cols: Sequence[str], bins: int = 5, digits: int = 4) -> DataFrame:
    """Per numeric column: missing, completeness, mean, sd, five quantiles and a small histogram."""
    moments = {
        "n_missing": lambda c: F.count_if(c.isNull()),
        "complete_rate": lambda c: F.round(F.avg(c.isNotNull().cast("double")), 4),
        "mean": lambda c: F.round(F.avg(c), digits),
        "sd": lambda c: F.round(F.stddev_samp(c), digits),
    }

    def hist(c: Column, low: Column, high: Column) -> Column:
        bin_id = equal_width_bin(c, low, high, bins)
        return F.concat_ws("|", *[F.count_if(bin_id == i).cast("string") for i in range(bins)])

    shape = wide_quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0], moments, {"hist": hist})
    names = ["p0", "p25", "p50", "p75", "p100"]
    return shape.select(
        F.col("variable").alias("column"),
        *moments,
        *[F.round(f"q{i}", digits).alias(n) for i, n in enumerate(names)],
        "hist",
    )


def profile(df: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Text and numeric profile of a table; None for a kind of column it lacks."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]
    return (profile_text(df, text) if text else None), (profile_numeric(df, numeric) if numeric else None)


def six_number(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Minimum, quartiles, mean and maximum per column."""
    marks = wide_quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0], {"mean": F.avg})
    names = ["min", "q1", "median", "q3", "max"]
    return marks.select(
        F.col("variable").alias("column"),
        *[F.round(f"q{i}", digits).alias(n) for i, n in enumerate(names)],
        F.round("mean", digits).alias("mean"),
    )


def validation_summary(tables: Mapping[str, DataFrame], count_duplicates: bool = True) -> DataFrame:
    """Rows, columns, missing cells and duplicate rows per table."""
    parts = []
    for name, df in tables.items():
        cells = [F.count_if(missing_in(f)) for f in df.schema]
        total = cells[0]
        for c in cells[1:]:
            total = total + c
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("n_missing"))
        row = row.withColumns({"table": F.lit(name), "n_columns": F.lit(len(df.columns))})
        if count_duplicates:
            row = row.withColumn("n_duplicates", duplicate_count(df).select("n_duplicates").scalar())
        parts.append(row)
    return stack_rows(parts).select(
        "table", "n_rows", "n_columns", "n_missing", *(["n_duplicates"] if count_duplicates else [])
    )


def stack_rows(parts: Iterable[DataFrame]) -> DataFrame:
    """Append tables by column name, filling absent columns with NULL."""
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def check_contract(df: DataFrame, expected: Sequence[str], table: str) -> DataFrame:
    """One row per expected or extra column name, with its status: ok, missing or extra."""
    found = set(df.columns)
    status = [(table, c, "ok" if c in found else "missing") for c in expected]
    status += [(table, c, "extra") for c in df.columns if c not in set(expected)]
    return df.sparkSession.createDataFrame(status, "table string, column string, status string")


def contract_holds(df: DataFrame, expected: Sequence[str]) -> bool:
    return set(expected) <= set(df.columns)


def bounds_check(
    df: DataFrame, lat: str, lon: str, lat_range: tuple[float, float], lon_range: tuple[float, float]
) -> DataFrame:
    """How many coordinate pairs lie in a box; a pair with a missing part is left out."""
    have = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    lat_ok, lon_ok = F.col(lat).between(*lat_range), F.col(lon).between(*lon_range)
    return have.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lat_ok & lon_ok).alias("n_valid"),
        F.count_if(~lat_ok).alias("n_bad_lat"),
        F.count_if(~lon_ok).alias("n_bad_lon"),
    ).withColumn("pct_valid", pct(F.col("n_valid"), F.col("n_rows")))


def domain_check(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Rows per value, with a flag for allowed values; NULL is not allowed."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("allowed", F.coalesce(F.col("value").isin(*allowed), F.lit(False)))


def audit_row(stage: str, description: str, before: DataFrame, after: DataFrame, stamp: bool = True) -> DataFrame:
    """Rows before and after a cleaning stage. The two counts run as one query."""
    out = before.agg(F.count(F.lit(1)).alias("n_before")).withColumn(
        "n_after", after.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    removed = F.col("n_before") - F.col("n_after")
    out = out.select(
        F.lit(stage).alias("stage"),
        F.lit(description).alias("description"),
        "n_before",
        "n_after",
        removed.alias("n_removed"),
        pct(removed, F.col("n_before")).alias("pct_removed"),
    )
    return out.withColumn("logged_at", F.current_timestamp()) if stamp else out


def retention(audit: DataFrame) -> DataFrame:
    """Kept share per audited table."""
    kept = pct(F.col("n_after"), F.col("n_before")).alias("pct_kept")
    return audit.select(F.col("stage").alias("table"), F.col("n_before"), F.col("n_after"), kept)


def n_distinct(c: str, count_null: bool = True) -> Column:
    """Distinct values; with `count_null`, NULL is one more value."""
    seen = F.count_distinct(c)
    return seen + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0)) if count_null else seen


def distinct_counts(df: DataFrame, distinct: Mapping[str, str], count_null: bool = True) -> DataFrame:
    """One row of distinct counts (output name -> column).

    Rows are grouped by all the columns first, so that only distinct combinations are expanded, once per column.
    """
    combinations = df.select(*dict.fromkeys(distinct.values())).distinct()
    return combinations.agg(*[n_distinct(c, count_null).alias(name) for name, c in distinct.items()])


def quality_metrics(
    df: DataFrame, distinct: Mapping[str, str], share: str, event: Column, digits: int = 3
) -> DataFrame:
    """Size, distinct counts (output name -> column), mean share, and events with their rate.

    One aggregate groups the rows by each counted column alone, and as a whole: a task holds the values of the columns,
    not their combinations, of which there may be as many as rows.
    """
    sums = {
        "_n": F.count(F.lit(1)), "_s": F.sum(F.col(share).cast("double")), "_k": F.count(share), "_e": F.count_if(event), "_ek": F.count(event),
    }
    cols = list(dict.fromkeys(distinct.values()))
    whole = (1 << len(cols)) - 1  # a bit for each column that a set leaves out, the first column's being the highest
    sets = df.groupingSets([*([c] for c in cols), []], *cols).agg(F.grouping_id().alias("_set"), *[c.alias(n) for n, c in sums.items()])

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("_set") == whole, F.col(name)))

    def values(c: str) -> Column:  # NULL is one more value
        return F.count_if(F.col("_set") == whole - (1 << (len(cols) - 1 - cols.index(c))))

    return sets.agg(
        total("_n").alias("n_rows"),
        *[values(c).alias(name) for name, c in distinct.items()],
        F.round(F.try_divide(total("_s"), total("_k")), digits).alias("mean_share"),
        total("_e").alias("n_events"),
        F.round(F.try_divide(total("_e"), total("_ek")) * 100, 2).alias("event_rate"),
    ).withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_rows", "n_events")})


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of levels per categorical column and whether there are at least two."""
    counts = distinct_counts(df, {f"_n{i}": c for i, c in enumerate(cols)}, count_null=False)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n_levels")) for i, c in enumerate(cols)]
    return counts.select(F.inline(F.array(*items))).withColumn("usable", F.col("n_levels") >= 2)


def require_two_classes(df: DataFrame, label: str) -> None:
    """Stop when the label has fewer than two classes."""
    found = df.select(label).where(F.col(label).isNotNull()).distinct().limit(2).count()
    if found < 2:
        raise ValueError(f"column {label!r} holds {found} class(es); two are needed")
