"""Histograms, densities, box statistics, trends, correlations and components."""

from pyspark.sql import functions as F

from padronix.operators import correlation, distribution, local_regression
from padronix.plans.catalog.base import LINES_PARTS, query
from padronix.plans.star import lines_parts, table


def _bin_sql(x, bins, lo="lo", hi="hi"):
    return f"greatest(0, least({bins - 1}, CAST(floor(({x} - {lo}) / (({hi} - {lo}) / {bins})) AS INTEGER)))"


def _histogram_sql(source, x, bins):
    return f"""
WITH r AS (SELECT min({x}) AS lo, max({x}) AS hi FROM {source}),
b AS (SELECT {_bin_sql(x, bins)} AS bin, lo, hi FROM {source}, r)
SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / {bins}, 6) AS low,
  round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / {bins}, 6) AS high, count(*) AS n
FROM b GROUP BY bin
"""


@query(_histogram_sql("lineitem", "l_extendedprice", 30))
def histogram(spark, d):
    return distribution.histogram(table(spark, d, "lineitem"), "l_extendedprice", 30)


@query(_histogram_sql("events", "value", 50))
def histogram_fine(spark, d):
    return distribution.histogram(table(spark, d, "events"), "value", 50)


@query(f"""
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n,
  0.9 * least(stddev_samp(l_extendedprice),
    (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) / 1.34) * pow(count(*), -0.2) AS h
  FROM lineitem),
b AS (SELECT floor((l_extendedprice - lo) / (h / 8)) AS bin, count(*) AS c FROM lineitem, r GROUP BY 1),
g AS (SELECT unnest(range(64)) AS point),
k AS (SELECT point, c * exp(-0.5 * (((hi - lo) / 63 * point - (bin + 0.5) * h / 8) / h) ** 2) AS part FROM b, g, r
  WHERE abs((hi - lo) / 63 * point - (bin + 0.5) * h / 8) <= 6 * h),
s AS (SELECT point, sum(part) AS total FROM k GROUP BY 1)
SELECT CAST(point AS INTEGER) AS point, round(lo + (hi - lo) * point / 63, 6) AS x,
  round(coalesce(total, 0) / (sqrt(2 * pi()) * h * n), 8) AS density
FROM g LEFT JOIN s USING (point), r
""")
def density(spark, d):
    return distribution.density(table(spark, d, "lineitem"), "l_extendedprice")


@query(f"""
WITH s AS ({LINES_PARTS}), q AS (SELECT p_type, quantile_cont(l_extendedprice, 0.25) AS a,
  quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.75) AS c FROM s GROUP BY 1),
j AS (SELECT s.p_type, l_extendedprice AS x, a, b, c, l_extendedprice BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a) AS i
  FROM s JOIN q ON q.p_type = s.p_type)
SELECT p_type, count(*) AS n, round(any_value(a), 4) AS q1, round(any_value(b), 4) AS median, round(any_value(c), 4) AS q3,
  round(min(x) FILTER (i), 4) AS whisker_low, round(max(x) FILTER (i), 4) AS whisker_high,
  count(*) FILTER (NOT i) AS n_outliers
FROM j GROUP BY 1
""")
def box_stats(spark, d):
    return distribution.box_stats(lines_parts(spark, d), "l_extendedprice", ["p_type"])


@query("""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS c FROM events GROUP BY 1),
j AS (SELECT e.event_type, NOT (value BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a)) AS o
  FROM events e JOIN q ON q.event_type = e.event_type)
SELECT event_type, count(*) AS n, count(*) FILTER (o) AS n_outliers, round(count(*) FILTER (o) * 100.0 / count(*), 4) AS pct_outliers
FROM j GROUP BY 1
""")
def iqr_outliers(spark, d):
    return distribution.outlier_counts(table(spark, d, "events"), "value", ["event_type"])


@query(f"""
WITH s AS ({LINES_PARTS}), r AS (SELECT min(p_size)::DOUBLE AS lo, max(p_size)::DOUBLE AS hi FROM s),
b AS (SELECT {_bin_sql("p_size", 10)} AS bin, p_size AS x, l_extendedprice AS y FROM s, r),
g AS (SELECT bin, count(*) AS n, avg(x) AS x, avg(y) AS m, stddev_samp(y) AS sd FROM b GROUP BY 1)
SELECT bin, n, round(x, 4) AS mean_x, round(m, 4) AS mean_y, round(sd, 4) AS sd_y,
  round(m - 1.96 * sd / sqrt(n), 4) AS low, round(m + 1.96 * sd / sqrt(n), 4) AS high
FROM g
""")
def binned_trend(spark, d):
    return distribution.binned_trend(lines_parts(spark, d), "p_size", "l_extendedprice", 10)


@query()
def local_trend(spark, d):
    return local_regression.local_regression(lines_parts(spark, d), "p_size", "l_extendedprice")


@query("""
WITH r AS (SELECT regr_slope(l_extendedprice, p_size) AS b, regr_intercept(l_extendedprice, p_size) AS a,
  min(p_size) AS lo, max(p_size) AS hi, count(*) AS n, avg(p_size) AS m, regr_sxx(l_extendedprice, p_size) AS sxx,
  sqrt((regr_syy(l_extendedprice, p_size) - regr_sxy(l_extendedprice, p_size) ** 2 / regr_sxx(l_extendedprice, p_size)) / (count(*) - 2)) AS s
  FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT CAST(unnest(range(40)) AS INTEGER) AS point)
SELECT point, round(lo + (hi - lo) * point / 39.0, 4) AS x, round(a + b * (lo + (hi - lo) * point / 39.0), 4) AS fit,
  round(s * sqrt(1.0 / n + (lo + (hi - lo) * point / 39.0 - m) ** 2 / sxx), 4) AS se FROM g, r
""")
def local_trend_of_wide_span(spark, d):
    """Lines fitted to all rows at nearly equal weights are one straight line, with its standard error."""
    out = local_regression.local_regression(lines_parts(spark, d), "p_size", "l_extendedprice", span=1e6, degree=1, points=40, digits=4)
    return out.select("point", "x", "fit", "se")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in NUMBERS
        for b in NUMBERS
        if a != b
    )
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in NUMBERS)
)
def corr_matrix(spark, d):
    return correlation.corr_matrix(table(spark, d, "lineitem"), NUMBERS, 6)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(corr({c}, l_discount), 6) AS r FROM lineitem"
        for c in NUMBERS
        if c != "l_discount"
    )
)
def corr_rank(spark, d):
    return correlation.corr_rank(table(spark, d, "lineitem"), "l_discount", NUMBERS, 6)


@query()
def pca_variance(spark, d):
    return correlation.principal_components(table(spark, d, "lineitem"), NUMBERS, 3)[0].select(
        "component", F.round("explained", 6).alias("explained"), F.round("cumulative", 6).alias("cumulative")
    )


@query()
def pca_loadings(spark, d):
    return correlation.principal_components(table(spark, d, "lineitem"), NUMBERS, 3)[1]
