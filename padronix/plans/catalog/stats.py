"""Counts, profiles, rates and summaries."""

from pyspark.sql import functions as F

from padronix.operators import stats
from padronix.plans.catalog.base import LINES_PARTS, PLACED, STAR, query, unpivot_sql
from padronix.plans.star import flagged_parts, lines_parts, lines_placed, orders_placed, star, table

MIN_GROUP = 20


@query(f"""
WITH s AS ({PLACED})
SELECT n_name, count(*) AS n, round(avg(l_discount), 6) AS mean, round(median(l_discount), 6) AS median,
  round(stddev_samp(l_discount), 6) AS sd, round(avg(l_discount) - (SELECT avg(l_discount) FROM s), 6) AS deviation,
  CASE WHEN length(n_name) > 8 THEN substr(n_name, 1, 5) || '...' ELSE n_name END AS label
FROM s GROUP BY n_name HAVING count(*) >= {MIN_GROUP}
""")
def flagship_group_profile(spark, d):
    return stats.group_profile(lines_placed(spark, d), "n_name", "l_discount", MIN_GROUP, label_width=8)


@query("""
SELECT event_type AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM events), 4) AS pct
FROM events GROUP BY 1
""")
def freq(spark, d):
    return stats.freq(table(spark, d, "events"), "event_type", 4)


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_returnflag), 4) AS row_pct
FROM lineitem GROUP BY 1, 2
""")
def crosstab(spark, d):
    return stats.crosstab(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", 4)


@query("""
SELECT l_linenumber, count(*) FILTER (l_returnflag = 'A') AS "A", count(*) FILTER (l_returnflag = 'N') AS "N",
  count(*) FILTER (l_returnflag = 'R') AS "R" FROM lineitem GROUP BY 1
""")
def crosstab_wide(spark, d):
    return stats.crosstab_wide(table(spark, d, "lineitem"), "l_linenumber", "l_returnflag", ["A", "N", "R"])


@query(f"""
SELECT r_name, p_type, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY r_name), 6) AS share
FROM ({STAR}) GROUP BY 1, 2
""")
def composition(spark, d):
    return stats.composition(star(spark, d), "r_name", "p_type", 6)


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]
DESCRIBE_SQL = """round(avg(value), 4) AS mean, round(median(value), 4) AS median, round(stddev_samp(value), 4) AS sd,
  round(quantile_cont(value, 0.25), 4) AS q1, round(quantile_cont(value, 0.75), 4) AS q3, round(min(value), 4) AS min,
  round(max(value), 4) AS max"""


@query(f"SELECT variable, {DESCRIBE_SQL} FROM ({unpivot_sql('lineitem', DESCRIBED)}) GROUP BY 1")
def describe_num(spark, d):
    return stats.describe_num(table(spark, d, "lineitem"), DESCRIBED)


@query(f"SELECT variable, event_type, {DESCRIBE_SQL} FROM ({unpivot_sql('events', ['value'], 'event_type')}) GROUP BY 1, 2")
def describe_num_by(spark, d):
    return stats.describe_num(table(spark, d, "events"), ["value"], ["event_type"])


@query(f"SELECT p_brand, count(*) AS n FROM ({LINES_PARTS}) GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def top_groups(spark, d):
    return stats.top_groups(lines_parts(spark, d), "p_brand", 10)


@query(f"""
WITH s AS ({LINES_PARTS}), t AS (SELECT p_brand FROM s GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10)
SELECT p_brand, count(*) AS n, round(avg(l_discount), 6) AS mean_share FROM s
WHERE p_brand IN (SELECT p_brand FROM t) GROUP BY 1
""")
def profile_top(spark, d):
    rows = lines_parts(spark, d)
    metrics = {"mean_share": F.round(F.avg("l_discount"), 6)}
    return stats.profile_groups(rows, "p_brand", metrics, keep=stats.top_groups(rows, "p_brand", 10))


@query("""
SELECT l_suppkey, round(sum(l_extendedprice), 2) AS price FROM lineitem WHERE l_suppkey IN (
  SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) >= 600) GROUP BY 1
""")
def filter_by_group_size(spark, d):
    big = stats.filter_by_group_size(table(spark, d, "lineitem"), "l_suppkey", 600)
    return big.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("price"))


PART_PRICE = "SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS price FROM part GROUP BY 1"


def _brands(spark, d):
    return (
        table(spark, d, "part")
        .groupBy("p_brand")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 4).alias("price"))
    )


@query(f"""
WITH g AS ({PART_PRICE}), m AS (SELECT avg(p_retailprice) AS m FROM part),
s AS (SELECT max(price) AS hi, min(price) AS lo, count(*) FILTER (price > m) AS a, count(*) FILTER (price <= m) AS b FROM g, m)
SELECT CASE WHEN price = hi THEN 'best' ELSE 'worst' END AS position, p_brand, price, round(hi - lo, 4) AS "range",
  a AS n_above, b AS n_not_above
FROM g, s WHERE price = hi OR price = lo
""")
def extremes(spark, d):
    overall = table(spark, d, "part").agg(F.avg("p_retailprice").alias("m")).scalar()
    return stats.extremes(_brands(spark, d), "p_brand", "price", overall, 4)


@query(f"""
SELECT p_brand, n, price FROM (SELECT *, rank() OVER (ORDER BY n DESC) AS r FROM ({PART_PRICE})) WHERE r <= 15
""")
def top_n_ties(spark, d):
    return stats.top_with_ties(_brands(spark, d), "n", 15)


AREA_SQL = f"""SELECT r_name, n_name, c_mktsegment, count(*) AS n, avg(share) AS mean_share,
  count(DISTINCT p_type) AS sectors, avg(CASE WHEN exported THEN 1.0 ELSE 0.0 END) AS export_rate,
  avg(CASE WHEN p_size <= 10 THEN 1.0 ELSE 0.0 END) AS small_share
FROM ({STAR}) GROUP BY 1, 2, 3 HAVING count(*) >= {MIN_GROUP}"""
AREA = ["r_name", "n_name", "c_mktsegment"]


def areas(spark, d):
    return stats.area_profile(
        star(spark, d), AREA, "share", "p_type", F.col("exported"), F.col("p_size") <= 10, MIN_GROUP
    )


@query(f"""
SELECT r_name, n_name, c_mktsegment, n, round(mean_share, 6) AS mean_share, sectors, round(export_rate, 6) AS export_rate,
  round(small_share, 6) AS small_share FROM ({AREA_SQL})
""")
def area_profile(spark, d):
    rounded = {c: F.round(c, 6) for c in ("mean_share", "export_rate", "small_share")}
    return areas(spark, d).withColumns(rounded)


@query(f"SELECT r_name, round(avg(mean_share), 6) AS mean_share, count(*) AS areas FROM ({AREA_SQL}) GROUP BY 1")
def area_rollup(spark, d):
    return stats.area_rollup(areas(spark, d), "r_name", 6)


@query(f"""
SELECT p_type = 'ECONOMY' AS economy, p_type = 'PROMO' AS promo, p_size > 25 AS big, count(*) AS n,
  count(*) FILTER (exported) AS events, round(count(*) FILTER (exported) * 100.0 / count(*), 4) AS rate
FROM ({STAR}) GROUP BY 1, 2, 3 HAVING count(*) > {MIN_GROUP}
""")
def rate_by(spark, d):
    flagged = flagged_parts(spark, d).withColumns(
        {"economy": F.col("p_type") == "ECONOMY", "promo": F.col("p_type") == "PROMO", "big": F.col("p_size") > 25}
    )
    return stats.rate_by(flagged, ["economy", "promo", "big"], F.col("exported"), MIN_GROUP, 4)


@query(f"""
SELECT kind, count(*) AS n, round(avg(share), 3) AS mean_share, round(avg(p_size), 1) AS mean_size,
  round(avg(CASE WHEN exported THEN 1.0 ELSE 0.0 END) * 100, 2) AS event_rate
FROM (SELECT *, CASE WHEN p_type = 'PROMO' THEN 'promo' ELSE 'rest' END AS kind FROM ({STAR})) GROUP BY 1
""")
def compare_groups(spark, d):
    rows = flagged_parts(spark, d).withColumn("kind", F.when(F.col("p_type") == "PROMO", "promo").otherwise("rest"))
    return stats.compare_groups(rows, "kind", "share", "p_size", F.col("exported"))


CONDITIONS = {"promo": "p_type = 'PROMO'", "large": "p_type = 'LARGE'", "heavy": "l_quantity > 40"}


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS condition, count(*) AS n, round(avg(CASE WHEN l_discount >= 0.05 THEN 1.0 ELSE 0.0 END), 6) AS rate
FROM ({LINES_PARTS}) WHERE {c}"""
        for name, c in CONDITIONS.items()
    )
)
def conditional_rate(spark, d):
    conditions = {name: F.expr(c) for name, c in CONDITIONS.items()}
    return stats.conditional_rates(lines_parts(spark, d), F.col("l_discount") >= 0.05, conditions, 6)


@query(f"""
SELECT count(*) AS n_rows, count(DISTINCT r_name) AS regions, count(DISTINCT n_name) AS areas,
  count(DISTINCT p_type) AS sectors, round(avg(share), 3) AS mean_share,
  round(avg(CASE WHEN exported THEN 1.0 ELSE 0.0 END) * 100, 2) AS event_rate, round(avg(p_size), 1) AS mean_size,
  round(median(share), 3) AS median_share
FROM ({STAR})
""")
def executive_summary(spark, d):
    names = {"regions": "r_name", "areas": "n_name", "sectors": "p_type"}
    return stats.executive_summary(star(spark, d), names, "share", F.col("exported"), "p_size")


@query(f"""
WITH s AS ({STAR}), a AS (SELECT count(*) AS n, avg(share) * 100 AS sh, avg(CASE WHEN exported THEN 1.0 ELSE 0.0 END) * 100 AS e FROM s)
SELECT 'rows' AS metric, replace(format('{{:,}}', n), ',', '.') AS value FROM a UNION ALL
SELECT 'most_common_region', (SELECT r_name FROM s GROUP BY 1 ORDER BY count(*) DESC, r_name LIMIT 1) UNION ALL
SELECT 'mean_share', format('{{:.1f}}%', sh) FROM a UNION ALL
SELECT 'event_rate', format('{{:.1f}}%', e) FROM a UNION ALL
SELECT 'most_common_sector', (SELECT p_type FROM s GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 1)
""")
def insights(spark, d):
    return stats.insights(star(spark, d), "r_name", "p_type", "share", F.col("exported"))


@query("""
SELECT l AS majority, round(n / t, 6) AS baseline_accuracy FROM (
  SELECT l_returnflag AS l, count(*)::DOUBLE AS n, sum(count(*)) OVER () AS t FROM lineitem GROUP BY 1)
ORDER BY n DESC, l DESC LIMIT 1
""")
def baseline(spark, d):
    return stats.baseline(table(spark, d, "lineitem"), "l_returnflag")


@query(f"""
SELECT r_name, exported, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY r_name), 4) AS row_pct
FROM ({STAR}) GROUP BY 1, 2
""")
def exports_by_region(spark, d):
    return stats.crosstab(star(spark, d), "r_name", "exported", 4)


@query(f"""
WITH c AS (SELECT p_brand, count(*) AS n FROM ({LINES_PARTS}) GROUP BY 1),
h AS (SELECT *, (SELECT sum(n) FROM c) AS t FROM c ORDER BY n DESC, p_brand LIMIT 20)
SELECT p_brand, n, round(n * 100.0 / t, 4) AS pct,
  round(sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) * 100.0 / t, 4) AS cum_pct
FROM h
""")
def concentration(spark, d):
    return stats.concentration(lines_parts(spark, d), "p_brand", 20, 4)


@query(f"""
WITH y AS (SELECT r_name, count(*) FILTER (o_year = 1996) AS b, count(*) FILTER (o_year = 1997) AS a
  FROM ({PLACED}) WHERE o_year IN (1996, 1997) GROUP BY 1)
SELECT r_name, b AS n_before, a AS n_after, a - b AS change, round((a - b) * 100.0 / b, 2) AS pct_change FROM y
""")
def yearly_change(spark, d):
    return stats.period_change(lines_placed(spark, d), "r_name", "o_year", 1996, 1997)


@query("""
SELECT n_name, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1 ORDER BY n DESC, n_name LIMIT 15
""")
def province_ranking(spark, d):
    return stats.top_groups(orders_placed(spark, d), "n_name", 15)


@query(f"""
SELECT p_type, r_name, round(avg(share), 6) AS mean,
  round(avg(share) - sum(sum(share)) OVER (PARTITION BY p_type) / sum(count(*)) OVER (PARTITION BY p_type), 6) AS gap
FROM ({STAR}) GROUP BY 1, 2
""")
def gender_gap_grid(spark, d):
    return stats.gap_grid(star(spark, d), "p_type", "r_name", "share")


@query("""
SELECT l_linenumber AS value, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'), 4) AS pct
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
""")
def export_intensity(spark, d):
    return stats.freq(table(spark, d, "lineitem").where("l_returnflag = 'R'"), "l_linenumber", 4)


@query(f"""
WITH c AS (SELECT r_name, p_type, count(*) AS n FROM ({STAR}) GROUP BY 1, 2)
SELECT r_name, p_type, n, round((n / sum(n) OVER (PARTITION BY r_name)) /
  (sum(n) OVER (PARTITION BY p_type) / sum(n) OVER ()), 6) AS lq
FROM c
""")
def location_quotient(spark, d):
    return stats.location_quotient(star(spark, d), "r_name", "p_type", 6)


@query("""
SELECT CAST(floor(l_quantity / 10) AS BIGINT) AS cell_lat, CAST(floor(l_extendedprice / 10000) AS BIGINT) AS cell_lon,
  count(*) AS n, round(avg(l_quantity), 4) AS center_lat, round(avg(l_extendedprice), 4) AS center_lon
FROM lineitem GROUP BY 1, 2
""")
def grid_cells(spark, d):
    return stats.grid_cells(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 10.0, 10000.0)
