"""Cleaning and derivation queries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.functions.text import shorten, squish, title_case
from padronix.functions.values import recode, safe_ratio, three_way
from padronix.operators import cleaning, joins, quality, quantiles, spelling
from padronix.plans.catalog.base import LINES_PARTS, STAR, query
from padronix.plans.catalog.quality import ALL_RULES, ORDERS_GAPS, order_rules, orders_gaps
from padronix.plans.star import lines_parts, table


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g')) AS text FROM documents")
def squish_text(spark, d):
    return table(spark, d, "documents").select("doc_id", squish(F.col("text")).alias("text"))


@query("""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
  lambda w: upper(w[1]) || lower(w[2:])), ' ') AS p_name FROM part
""")
def title_case_names(spark, d):
    return table(spark, d, "part").select("p_partkey", title_case(F.col("p_name")).alias("p_name"))


PRIORITY_RULES = [("^1-|^2-", "Alta"), ("^3-medium$|^3-MEDIUM$", "Media"), ("^5-", "Baja")]


@query("""
SELECT CASE WHEN regexp_matches(o_orderpriority, '^1-|^2-') THEN 'Alta'
  WHEN regexp_matches(o_orderpriority, '^3-medium$|^3-MEDIUM$') THEN 'Media'
  WHEN regexp_matches(o_orderpriority, '^5-') THEN 'Baja' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n
FROM orders GROUP BY 1
""")
def canonicalize(spark, d):
    named = cleaning.canonicalize(table(spark, d, "orders"), "o_orderpriority", PRIORITY_RULES)
    return named.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, CAST(trunc(value) AS INTEGER) AS as_whole, CAST(NULL AS INTEGER) AS bad_whole, value AS as_number,
  TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
""")
def conform(spark, d):
    raw = table(spark, d, "events").select(
        "event_id",
        F.col("value").cast("string").alias("as_whole"),
        F.col("props").alias("bad_whole"),
        F.col("value").cast("string").alias("as_number"),
        F.regexp_extract("props", "[0-9]+", 0).alias("k"),
    )
    whole, number = T.IntegerType(), T.DoubleType()
    kinds = {"as_whole": whole, "bad_whole": whole, "as_number": number, "k": whole}
    return cleaning.conform(raw, T.StructType([T.StructField(n, t) for n, t in kinds.items()]))


FIRST = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(FIRST)}) AS rn FROM lineitem)
WHERE rn = 1
""")
def dedupe_first(spark, d):
    first = cleaning.dedupe(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], FIRST)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(f"SELECT o_orderkey, o_orderstatus, o_totalprice, c_name FROM ({ORDERS_GAPS}) WHERE {ALL_RULES}")
def apply_rules(spark, d):
    kept = cleaning.apply_rules(orders_gaps(spark, d), order_rules())
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice", "c_name")


@query(f"""
SELECT o_orderstatus, count(*) AS n, round(avg(c_acctbal), 4) AS mean_balance FROM ({ORDERS_GAPS})
WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY 1
""")
def complete_cases(spark, d):
    kept = cleaning.complete_cases(orders_gaps(spark, d), ["c_acctbal", "c_mktsegment"])
    return kept.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance")
    )


@query(f"""
WITH j AS (SELECT o_orderkey, c_acctbal,
  CASE WHEN o_orderstatus = 'P' THEN CAST('Infinity' AS DOUBLE) ELSE o_totalprice END AS price FROM ({ORDERS_GAPS}))
SELECT o_orderkey, coalesce(c_acctbal, 0.0) AS c_acctbal, CASE WHEN isinf(price) THEN 0.0 ELSE price END AS price FROM j
""")
def fill_nonfinite(spark, d):
    price = F.when(F.col("o_orderstatus") == "P", float("inf")).otherwise(F.col("o_totalprice")).alias("price")
    rows = orders_gaps(spark, d).select("o_orderkey", "c_acctbal", price)
    return cleaning.fill_nonfinite(rows, ["c_acctbal", "price"])


@query("""
SELECT l_suppkey, round(CASE WHEN d > 0 THEN n / d ELSE 0 END, 6) AS ratio FROM (
  SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R')::DOUBLE AS n, count(*) FILTER (l_quantity = 50 AND l_tax = 0) AS d
  FROM lineitem GROUP BY 1)
""")
def guarded_ratio(spark, d):
    counts = (
        table(spark, d, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("n"),
            F.count_if((F.col("l_quantity") == 50) & (F.col("l_tax") == 0)).alias("d"),
        )
    )
    return counts.select("l_suppkey", F.round(safe_ratio(F.col("n"), F.col("d")), 6).alias("ratio"))


MIDPOINTS = {5.0: ["ECONOMY"], 29.5: ["SMALL"], 74.5: ["MEDIUM"], 149.5: ["STANDARD"], 349.5: ["LARGE"]}
SIZE_CLASS = {"Micro": ["ECONOMY"], "Chica": ["SMALL", "MEDIUM"], "Grande": ["STANDARD", "LARGE"]}


@query("""
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 5.0::DOUBLE WHEN 'SMALL' THEN 29.5 WHEN 'MEDIUM' THEN 74.5
    WHEN 'STANDARD' THEN 149.5 WHEN 'LARGE' THEN 349.5 END AS midpoint,
  CASE WHEN p_type = 'ECONOMY' THEN 'Micro' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Chica'
    WHEN p_type IN ('STANDARD', 'LARGE') THEN 'Grande' ELSE 'Desconocido' END AS size_class
FROM part
""")
def map_values(spark, d):
    kind = F.col("p_type")
    return table(spark, d, "part").select(
        "p_partkey",
        recode(kind, MIDPOINTS).alias("midpoint"),
        recode(kind, SIZE_CLASS, "Desconocido").alias("size_class"),
    )


@query("""
SELECT CASE WHEN l_linenumber = 1 THEN 'No exporta' WHEN l_linenumber = 2 THEN 'Bajo'
    WHEN l_linenumber IN (3, 4) THEN 'Medio' WHEN l_linenumber IN (5, 6) THEN 'Alto' ELSE 'Desconocido' END AS class,
  l_linenumber > 1 AS flag, count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def bucketize(spark, d):
    rules = {"No exporta": [1], "Bajo": [2], "Medio": [3, 4], "Alto": [5, 6]}
    rows = table(spark, d, "lineitem").select(
        recode(F.col("l_linenumber"), rules, "Desconocido").alias("class"), (F.col("l_linenumber") > 1).alias("flag")
    )
    return rows.groupBy("class", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT share, CASE WHEN share < 0.3 THEN 'low' WHEN share > 0.7 THEN 'high' ELSE 'mixed' END AS cut_open,
  CASE WHEN share < 0.3 THEN 'low' WHEN share < 0.7 THEN 'mixed' ELSE 'high' END AS cut_closed, count(*) AS n
FROM (SELECT l_discount * 10 AS share FROM lineitem) GROUP BY 1, 2, 3
""")
def composition_cut(spark, d):
    share, labels = F.col("share"), ("low", "mixed", "high")
    rows = table(spark, d, "lineitem").select((F.col("l_discount") * 10).alias("share"))
    cuts = rows.select(
        "share",
        three_way(share, 0.3, 0.7, labels, upper_closed=False).alias("cut_open"),
        three_way(share, 0.3, 0.7, labels, upper_closed=True).alias("cut_closed"),
    )
    return cuts.groupBy("share", "cut_open", "cut_closed").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT n_name, CASE WHEN n_name IN ('NATION_0', 'NATION_5') THEN 'Norte' WHEN n_name IN ('NATION_1', 'NATION_6') THEN 'Sur'
  ELSE 'Otras' END AS zone FROM nation
""")
def region_lookup(spark, d):
    zones = {"Norte": ["NATION_0", "NATION_5"], "Sur": ["NATION_1", "NATION_6"]}
    return table(spark, d, "nation").select("n_name", recode(F.col("n_name"), zones, "Otras").alias("zone"))


@query("""
SELECT p_type AS value, count(*) AS n FROM part
WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'MEDIUM', 'STANDARD', 'LARGE') GROUP BY 1
""")
def unmapped_values(spark, d):
    mapped = table(spark, d, "part").select(
        F.col("p_type").alias("value"), recode(F.col("p_type"), SIZE_CLASS, "Desconocido").alias("size_class")
    )
    return cleaning.unmapped(mapped, "value", "size_class", "Desconocido")


@query("""
WITH m AS (SELECT avg(p_retailprice) AS m FROM part)
SELECT p_partkey, round(p_retailprice - m, 6) AS deviation,
  CASE WHEN length(p_name) > 10 THEN substr(p_name, 1, 7) || '...' ELSE p_name END AS label FROM part, m
""")
def deviation_from_mean(spark, d):
    part = table(spark, d, "part")
    overall = part.agg(F.avg("p_retailprice").alias("m")).scalar()
    return part.select(
        "p_partkey",
        F.round(F.col("p_retailprice") - overall, 6).alias("deviation"),
        shorten(F.col("p_name"), 10).alias("label"),
    )


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_year, c_mktsegment, n_name, r_name, p_brand, p_type FROM ({STAR})")
def star_integrate(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    places = joins.integrate(
        table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey"),
        [(table(spark, d, "region"), ["r_regionkey"])],
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("c_custkey"),
        F.year("o_orderdate").alias("o_year"),
    )
    orders = joins.integrate(orders, [(joins.integrate(customer, [(places, ["c_nationkey"])]), ["c_custkey"])])
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    full = joins.integrate(lines, [(orders, ["l_orderkey"]), (part, ["l_partkey"])])
    return full.drop("c_custkey", "c_nationkey")


@query("""
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1
""")
def keep_valid(spark, d):
    big = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    kept = joins.keep_valid(table(spark, d, "lineitem"), big, ["l_partkey"])
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query("""
SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 4) AS gap FROM orders
""")
def scalar_join(spark, d):
    orders = table(spark, d, "orders")
    joined = joins.attach_scalar(orders, orders.agg(F.avg("o_totalprice").alias("m")), "m", "overall")
    return joined.select("o_orderkey", F.round(F.col("o_totalprice") - F.col("overall"), 4).alias("gap"))


@query("""
SELECT 'lineitem' AS "table", count(*) AS n, count(DISTINCT l_partkey) AS parts FROM lineitem
UNION ALL SELECT 'part', count(*), NULL FROM part
""")
def append_rows(spark, d):
    def row(name, *extra):
        df = table(spark, d, name).agg(F.count(F.lit(1)).alias("n"), *extra)
        return df.withColumn("table", F.lit(name))

    return quality.stack_rows([row("lineitem", F.count_distinct("l_partkey").alias("parts")), row("part")])


@query(f"""
WITH s AS ({LINES_PARTS})
SELECT variable, p_type, round(sum(value), 2) AS total FROM (
  SELECT 'l_quantity' AS variable, p_type, l_quantity AS value FROM s UNION ALL
  SELECT 'l_tax', p_type, l_tax FROM s UNION ALL SELECT 'l_discount', p_type, l_discount FROM s) GROUP BY 1, 2
""")
def unpivot(spark, d):
    long = quantiles.unpivot(lines_parts(spark, d), ["l_quantity", "l_tax", "l_discount"], ["p_type"])
    return long.groupBy("variable", "p_type").agg(F.round(F.sum("value"), 2).alias("total"))


# Nation names of customers with letters dropped, replaced or moved, in other cases, or replaced by another word.
SPELLINGS = """SELECT c_custkey, CASE c_custkey % 6
    WHEN 1 THEN substring(n_name, 1, k) || substring(n_name, k + 2) WHEN 2 THEN substring(n_name, 1, k) || '#' || substring(n_name, k + 2)
    WHEN 3 THEN 'Z' || substring(n_name, 1, CAST(length(n_name) - 1 AS INTEGER)) WHEN 4 THEN c_mktsegment WHEN 5 THEN lower(n_name) ELSE n_name END AS spelling
  FROM (SELECT c.*, n.n_name, CAST(c_custkey % length(n_name) AS INTEGER) AS k FROM customer c JOIN nation n ON c_nationkey = n_nationkey)"""

NEAREST = f"""WITH s AS (SELECT spelling, count(*) AS n FROM ({SPELLINGS}) GROUP BY 1),
d AS (SELECT spelling, n_name, CAST(levenshtein(lower(spelling), lower(n_name)) AS INTEGER) AS distance FROM s, nation),
r AS (SELECT spelling, distance, count(*) AS n_ties, min(n_name) AS n_name FROM d WHERE distance <= 2 GROUP BY 1, 2),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY spelling ORDER BY distance) = 1),
m AS (SELECT spelling, n, CASE WHEN n_ties = 1 THEN n_name END AS match, distance, coalesce(n_ties, 0) AS n_ties
  FROM s LEFT JOIN b USING (spelling))"""


def _spelled(spark, d):
    named = table(spark, d, "customer").join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    name, k = F.col("n_name"), (F.col("c_custkey") % F.length("n_name")).cast("int")
    head, tail = F.substring(name, F.lit(1), k), F.substring(name, k + 2, F.length(name))
    way = F.col("c_custkey") % 6
    spelling = (
        F.when(way == 1, F.concat(head, tail))
        .when(way == 2, F.concat(head, F.lit("#"), tail))
        .when(way == 3, F.concat(F.lit("Z"), F.substring(name, F.lit(1), F.length(name) - 1)))
        .when(way == 4, F.col("c_mktsegment"))
        .when(way == 5, F.lower(name))
        .otherwise(name)
    )
    return named.select("c_custkey", spelling.alias("spelling"))


def _matches(spark, d):
    return spelling.match_names(_spelled(spark, d), "spelling", table(spark, d, "nation"), "n_name", 2, F.lower)


@query(f"{NEAREST} SELECT * FROM m")
def match_names(spark, d):
    return _matches(spark, d)


@query(f"""{NEAREST} SELECT coalesce(match, q.spelling) AS spelling, count(*) AS n FROM ({SPELLINGS}) q JOIN m USING (spelling) GROUP BY 1""")
def repair_names(spark, d):
    fixed = spelling.repair_names(_spelled(spark, d), "spelling", _matches(spark, d))
    return fixed.groupBy("spelling").agg(F.count(F.lit(1)).alias("n"))
