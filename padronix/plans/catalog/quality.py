"""Data-quality queries."""

from pyspark.sql import functions as F

from padronix.operators import cleaning, joins, quality
from padronix.plans.catalog.base import STAR, query, unpivot_sql
from padronix.plans.star import lines_parts, star, table

# Orders beside their customer where that has a positive balance: a table with missing cells.
ORDERS_GAPS = """SELECT o.*, c.c_name, c.c_acctbal, c.c_mktsegment FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = o.o_custkey"""


def orders_gaps(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 0")
    rich = rich.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal", "c_mktsegment")
    return table(spark, d, "orders").join(rich, "o_custkey", "left")


@query(f"""
WITH j AS ({ORDERS_GAPS}), t AS (
  SELECT count(*) AS n, count(*) FILTER (c_name IS NULL) AS a, count(*) FILTER (c_acctbal IS NULL) AS b,
    count(*) FILTER (c_mktsegment IS NULL) AS c FROM j)
SELECT 'c_name' AS "column", a AS n_missing, round(a * 100.0 / n, 2) AS pct_missing FROM t UNION ALL
SELECT 'c_acctbal', b, round(b * 100.0 / n, 2) FROM t UNION ALL
SELECT 'c_mktsegment', c, round(c * 100.0 / n, 2) FROM t
""")
def missing_report(spark, d):
    return quality.missing_report(orders_gaps(spark, d))


@query("""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(c) - count(*) AS BIGINT) AS n_duplicates,
  round((sum(c) - count(*)) * 100.0 / sum(c), 2) AS pct_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def duplicate_count(spark, d):
    return quality.duplicate_count(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH u AS (
  SELECT 'text' AS "column", text AS value FROM documents UNION ALL
  SELECT 'lang', lang FROM documents UNION ALL SELECT 'source', source FROM documents)
SELECT "column", count(*) FILTER (value IS NULL) AS n_missing,
  round(avg(CASE WHEN value IS NOT NULL THEN 1.0 ELSE 0.0 END), 4) AS complete_rate,
  CAST(min(length(value)) AS INTEGER) AS min_length, CAST(max(length(value)) AS INTEGER) AS max_length,
  count(*) FILTER (value = '') AS n_empty, count(DISTINCT value) AS n_unique,
  count(*) FILTER (regexp_full_match(value, '\\s+')) AS n_blank
FROM u GROUP BY 1
""")
def column_profile_text(spark, d):
    return quality.profile_text(table(spark, d, "documents"), ["text", "lang", "source"])


PROFILED = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
BINS = "least(4, CAST(floor((value - lo) / ((hi - lo) / 5)) AS INTEGER))"


@query(f"""
WITH u AS ({unpivot_sql("lineitem", PROFILED)}),
s AS (SELECT variable, count(*) FILTER (value IS NULL) AS n_missing, 1.0::DOUBLE AS complete_rate, avg(value) AS mean,
  stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS p25,
  quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 FROM u GROUP BY 1),
b AS (SELECT u.variable, concat_ws('|', count(*) FILTER ({BINS} = 0), count(*) FILTER ({BINS} = 1),
  count(*) FILTER ({BINS} = 2), count(*) FILTER ({BINS} = 3), count(*) FILTER ({BINS} = 4)) AS hist
  FROM u JOIN s ON s.variable = u.variable GROUP BY 1)
SELECT s.variable AS "column", n_missing, complete_rate, round(mean, 4) AS mean, round(sd, 4) AS sd,
  round(lo, 4) AS p0, round(p25, 4) AS p25, round(p50, 4) AS p50, round(p75, 4) AS p75, round(hi, 4) AS p100, hist
FROM s JOIN b ON b.variable = s.variable
""")
def column_profile_numeric(spark, d):
    return quality.profile_numeric(table(spark, d, "lineitem"), PROFILED)


SIX = ["l_quantity", "l_extendedprice"]


@query(f"""
WITH u AS ({unpivot_sql("lineitem", SIX)})
SELECT variable AS "column", round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q1,
  round(median(value), 4) AS median, round(avg(value), 4) AS mean, round(quantile_cont(value, 0.75), 4) AS q3,
  round(max(value), 4) AS max
FROM u GROUP BY 1
""")
def six_number(spark, d):
    return quality.six_number(table(spark, d, "lineitem"), SIX)


VALIDATED = ["customer", "orders", "part", "supplier", "events"]


def _summary_sql(t):
    return f"""SELECT '{t}' AS "table", (SELECT count(*) FROM {t}) AS n_rows,
  CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS INTEGER) AS n_columns,
  CAST(0 AS BIGINT) AS n_missing,
  (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n_duplicates"""


@query(" UNION ALL ".join(_summary_sql(t) for t in VALIDATED))
def validation_summary(spark, d):
    return quality.validation_summary({t: table(spark, d, t) for t in VALIDATED})


# An expected layout that lacks l_tax and asks for a column the table does not have.
EXPECTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_returnflag", "l_linestatus", "l_shipdate", "l_comment"]


@query(f"""
WITH e AS (SELECT unnest({EXPECTED}) AS c),
f AS (SELECT column_name AS c FROM information_schema.columns WHERE table_name = 'lineitem')
SELECT 'lineitem' AS "table", e.c AS "column", CASE WHEN f.c IS NULL THEN 'missing' ELSE 'ok' END AS status
FROM e LEFT JOIN f ON f.c = e.c
UNION ALL SELECT 'lineitem', f.c, 'extra' FROM f WHERE f.c NOT IN (SELECT c FROM e)
""")
def contract_report(spark, d):
    return quality.check_contract(table(spark, d, "lineitem"), EXPECTED, "lineitem")


def order_rules():
    return {
        "status_known": F.col("o_orderstatus").isin("O", "F"),
        "customer_present": F.col("c_name").isNotNull(),
        "price_in_range": F.col("o_totalprice").between(10_000, 400_000),
    }


RULES_SQL = {
    "status_known": "o_orderstatus IN ('O', 'F')",
    "customer_present": "c_name IS NOT NULL",
    "price_in_range": "o_totalprice BETWEEN 10000 AND 400000",
}
ALL_RULES = " AND ".join(RULES_SQL.values())


@query(
    f"WITH j AS ({ORDERS_GAPS}) "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) FILTER (NOT ({rule})) AS n_rejected,
  count(*) FILTER ({ALL_RULES}) AS n_kept, count(*) AS n_rows FROM j"""
        for name, rule in RULES_SQL.items()
    )
)
def rule_report(spark, d):
    return cleaning.rule_report(orders_gaps(spark, d), order_rules())


def _audit(spark, d):
    gaps, lines = orders_gaps(spark, d), table(spark, d, "lineitem")
    keys = lines.select("l_orderkey", "l_linenumber")
    return quality.stack_rows(
        [
            quality.audit_row("orders", "rules", gaps, cleaning.apply_rules(gaps, order_rules()), stamp=False),
            quality.audit_row("lineitem", "keep-first", keys, keys.distinct(), stamp=False),
        ]
    )


AUDIT_SQL = f"""SELECT 'orders' AS stage, 'rules' AS description, count(*) AS b, count(*) FILTER ({ALL_RULES}) AS a
FROM ({ORDERS_GAPS}) UNION ALL
SELECT 'lineitem', 'keep-first', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"""


@query(f"""
SELECT stage, description, b AS n_before, a AS n_after, b - a AS n_removed, round((b - a) * 100.0 / b, 2) AS pct_removed
FROM ({AUDIT_SQL})
""")
def audit_log(spark, d):
    return _audit(spark, d)


@query(f'SELECT stage AS "table", b AS n_before, a AS n_after, round(a * 100.0 / b, 2) AS pct_kept FROM ({AUDIT_SQL})')
def retention(spark, d):
    return quality.retention(_audit(spark, d))


@query(f"""
WITH s AS ({STAR})
SELECT count(*) AS n_rows, count(DISTINCT r_name) AS regions, count(DISTINCT n_name) AS areas,
  count(DISTINCT l_partkey) AS activities, count(DISTINCT o_year) AS years, round(avg(share), 3) AS mean_share,
  count(*) FILTER (exported) AS n_events, round(avg(CASE WHEN exported THEN 1.0 ELSE 0.0 END) * 100, 2) AS event_rate
FROM s
""")
def kpis(spark, d):
    names = {"regions": "r_name", "areas": "n_name", "activities": "l_partkey", "years": "o_year"}
    return quality.quality_metrics(star(spark, d), names, "share", F.col("exported"))


@query("""
WITH f AS (SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1)
SELECT o_custkey, n_rows FROM f WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def orphan_keys_single(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.orphan_keys(table(spark, d, "orders"), rich, ["o_custkey"])


ORPHAN_PAIRS = """SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_quantity > 25 AND m.l_partkey = l.l_partkey
  AND m.l_suppkey = l.l_suppkey) GROUP BY 1, 2"""


def _orphan_pairs(spark, d):
    lines = table(spark, d, "lineitem")
    return joins.orphan_keys(lines, lines.where("l_quantity > 25"), ["l_partkey", "l_suppkey"])


@query(ORPHAN_PAIRS)
def orphan_keys_composite(spark, d):
    return _orphan_pairs(spark, d)


@query(f"""
WITH o AS ({ORPHAN_PAIRS}),
h AS (SELECT concat_ws('-', l_partkey, l_suppkey) AS k FROM o ORDER BY l_partkey, l_suppkey LIMIT 10)
SELECT count(*) AS n_keys, CAST(sum(n_rows) AS BIGINT) AS n_rows, (SELECT string_agg(k, ',' ORDER BY k) FROM h) AS examples
FROM o
""")
def orphan_summary(spark, d):
    return joins.orphan_summary(_orphan_pairs(spark, d), ["l_partkey", "l_suppkey"])


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (a AND b) AS n_valid, count(*) FILTER (NOT a) AS n_bad_lat,
  count(*) FILTER (NOT b) AS n_bad_lon, round(count(*) FILTER (a AND b) * 100.0 / count(*), 2) AS pct_valid
FROM (SELECT l_quantity BETWEEN 5 AND 45 AS a, l_extendedprice BETWEEN 2000 AND 90000 AS b FROM lineitem)
""")
def bounds_check(spark, d):
    return quality.bounds_check(
        table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", (5.0, 45.0), (2000.0, 90000.0)
    )


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS value, count(*) AS n, year(o_orderdate) IN (1996, 1997, 1998) AS allowed
FROM orders GROUP BY 1, 3
""")
def domain_check(spark, d):
    orders = table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    return quality.domain_check(orders, "o_year", [1996, 1997, 1998])


LEVELS = ["l_returnflag", "l_linestatus", "p_brand", "p_type"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_levels, count(DISTINCT {c}) >= 2 AS usable "
        "FROM lineitem JOIN part ON p_partkey = l_partkey"
        for c in LEVELS
    )
)
def level_counts(spark, d):
    return quality.level_counts(lines_parts(spark, d), LEVELS)
