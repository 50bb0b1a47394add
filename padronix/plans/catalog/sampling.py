"""Sampling, splitting and feature preparation."""

from pyspark.sql import functions as F

from padronix.operators import features, sampling
from padronix.plans.catalog.base import LINE_MD5, query
from padronix.plans.star import LINE_KEY, table

KEY_SQL = ", ".join(LINE_KEY)
SHUFFLED = f"SELECT *, {LINE_MD5} AS h FROM lineitem"


@query(f"SELECT {KEY_SQL}, l_extendedprice FROM ({SHUFFLED}) ORDER BY h LIMIT 5000")
def sample_n(spark, d):
    sample = sampling.sample_n(table(spark, d, "lineitem"), 5000, 42, LINE_KEY)
    return sample.select(*LINE_KEY, "l_extendedprice")


@query(f"""
SELECT {KEY_SQL}, l_returnflag, rn <= ceil(n * 0.8) AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY h) AS rn,
    count(*) OVER (PARTITION BY l_returnflag) AS n FROM ({SHUFFLED}))
""")
def stratified_split(spark, d):
    split = sampling.stratified_split(table(spark, d, "lineitem"), "l_returnflag", 0.8, 42, LINE_KEY)
    return split.select(*LINE_KEY, "l_returnflag", "is_train")


@query(f"""
SELECT {KEY_SQL}, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY h) AS rn FROM ({SHUFFLED}))
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag))
""")
def downsample(spark, d):
    return sampling.downsample(table(spark, d, "lineitem"), "l_returnflag", 42, LINE_KEY).select(
        *LINE_KEY, "l_returnflag"
    )


@query(f"""
SELECT {KEY_SQL}, l_returnflag,
  CAST(ntile(5) OVER (PARTITION BY l_returnflag ORDER BY h) - 1 AS INTEGER) AS fold FROM ({SHUFFLED})
""")
def folds(spark, d):
    return sampling.assign_folds(table(spark, d, "lineitem"), "l_returnflag", 5, 42, LINE_KEY).select(
        *LINE_KEY, "l_returnflag", "fold"
    )


FLAGS = {
    "is_promo": "p_name LIKE '%ring%'",
    "is_big": "p_size > 25",
    "north": "p_retailprice > 950",
    "is_economy": "p_type = 'ECONOMY'",
}


@query("SELECT p_partkey, " + ", ".join(f"CAST({c} AS INTEGER) AS {n}" for n, c in FLAGS.items()) + " FROM part")
def flags(spark, d):
    flagged = features.flags(table(spark, d, "part"), {n: F.expr(c) for n, c in FLAGS.items()})
    return flagged.select("p_partkey", *FLAGS)


@query("""
SELECT CASE WHEN l_discount >= 0.05 THEN 'Alta' ELSE 'Baja' END AS target, count(*) AS n FROM lineitem GROUP BY 1
""")
def target_cut(spark, d):
    cut = table(spark, d, "lineitem").select(features.target_at(F.col("l_discount"), 0.05).alias("target"))
    return cut.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > (SELECT median(c_acctbal) FROM customer) THEN 'Alta' ELSE 'Baja' END AS target
FROM customer
""")
def median_split(spark, d):
    return features.median_split(table(spark, d, "customer"), "c_acctbal", "target").select("c_custkey", "target")


@query("""
WITH m AS (SELECT avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s, avg(p_size) AS a, stddev_samp(p_size) AS b
  FROM part WHERE p_type <> 'PROMO')
SELECT p_partkey, round((p_retailprice - m) / s, 6) AS p_retailprice, round((p_size - a) / b, 6) AS p_size
FROM part, m WHERE p_type = 'PROMO'
""")
def standardize(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice", "p_size")
    train, test = part.where("p_type <> 'PROMO'"), part.where("p_type = 'PROMO'")
    _, scaled = features.standardize(train, test, ["p_retailprice", "p_size"])
    return scaled.select("p_partkey", *[F.round(c, 6).alias(c) for c in ("p_retailprice", "p_size")])


@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def drop_constant(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", F.lit(24).alias("provinces"))
    return features.drop_constant(part, ["p_size", "p_retailprice", "provinces"])
