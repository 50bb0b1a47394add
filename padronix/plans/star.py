"""The order tables as a registry-shaped star, for running every operator on them.

Line items are the establishments: the discount is the share-like column (0..0.1, times 10), a returned
line the exporter, the part its activity, the customer's nation its area, the order year its year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with nation and region names."""
    nation = table(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    places = nation.join(table(spark, folder, "region"), "r_regionkey", "left")
    places = places.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return table(spark, folder, "customer").join(places, "c_nationkey", "left")


def orders_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with year and place: joined before the lines, so that lines move once."""
    customers = customers_placed(spark, folder).select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name", "r_name"
    )
    orders = table(spark, folder, "orders").withColumn("o_year", F.year("o_orderdate"))
    return orders.join(customers, "o_custkey", "left")


def lines_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the order's year, segment, nation and region."""
    orders = orders_placed(spark, folder).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_year", "o_orderpriority", "c_mktsegment", "n_name", "r_name"
    )
    return table(spark, folder, "lineitem").join(orders, "l_orderkey", "left")


def lines_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with brand, type and size of the part."""
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size"
    )
    return table(spark, folder, "lineitem").join(part, "l_partkey", "left")


def flagged_parts(spark: SparkSession, folder: str) -> DataFrame:
    """`lines_parts` with the registry-like columns: for queries that read nothing of orders and customers."""
    return lines_parts(spark, folder).withColumns({"share": F.col("l_discount") * 10, "exported": F.col("l_returnflag") == "R"})


def star(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with every dimension and the registry-like columns."""
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size"
    )
    rows = lines_placed(spark, folder).join(part, "l_partkey", "left")
    return rows.withColumns({"share": F.col("l_discount") * 10, "exported": F.col("l_returnflag") == "R"})
