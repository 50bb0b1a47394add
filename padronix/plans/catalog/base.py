"""Named queries on the order tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a query under its function's name; without SQL only its rows are checked."""

    def register(build: Builder) -> Builder:
        QUERIES[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register


# SQL views shared by the oracles.
PLACED = """SELECT l.*, CAST(year(o.o_orderdate) AS INTEGER) AS o_year, o.o_orderpriority, c.c_mktsegment,
  n.n_name, r.r_name
FROM lineitem l
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""

STAR = f"""SELECT q.*, p.p_brand, p.p_type, p.p_size, q.l_discount * 10 AS share, q.l_returnflag = 'R' AS exported
FROM ({PLACED}) q LEFT JOIN part p ON p.p_partkey = q.l_partkey"""

LINES_PARTS = """SELECT l.*, p.p_brand, p.p_type, p.p_size
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey"""

LINE_MD5 = "md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey))"


def unpivot_sql(source: str, columns: list[str], extra: str = "") -> str:
    """Long form of numeric columns for use in an oracle."""
    pick = f", {extra}" if extra else ""
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value{pick} FROM {source}" for c in columns)
