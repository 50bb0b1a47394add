"""The folder that driver and executors share, for tables between the steps of long jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a local session without the setting, as in tests, gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/padronix-{uuid.uuid4().hex}"


def kept(table: DataFrame) -> DataFrame:
    """`table` persisted in the partitions that a query over it would read.

    Spark by default leaves the partitions of a kept table as many as its shuffles have, where a query joins small ones. Sums are then
    added up in another order, and their last digits differ.
    """
    conf, name = table.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return table.persist()
    finally:
        conf.set(name, before)


# Rows of 100 KB and more: by its defaults Parquet holds a hundred of them a page, and hundreds a row group, in buffers of
# every task that writes or reads, and outside the heap where pages are compressed.
LARGE_ROWS = {
    "compression": "none", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 8,
    "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 8,
}


def written(table: DataFrame, path: str, large_rows: bool = False) -> DataFrame:
    """Write a table and read it back, which cuts its lineage there. `large_rows` suits rows that hold packed arrays."""
    options = LARGE_ROWS if large_rows else {}
    table.write.options(**options).mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
