"""Tables published by partition: readers see the old partitions or the new ones, never a half-written state.

Every publication writes its partitions to a folder of its own and then adds one small file to the table's list. The
list's file n says where each partition lies from then on. Files never change, so a reader that has begun stays whole.
Two publications at once are told apart by the name of that file, where renaming refuses a name that is taken (HDFS).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class PublishConflict(RuntimeError):
    """Another publication was finished since this one began."""


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, make = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(make(path))) if fs.exists(make(path)) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished publications, oldest first."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/list") if n.endswith(".json") and n[:-5].isdigit()]


def _entry(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{path}/list/{version:08d}.json", wholetext=True).first()[0])


def _add_entry(spark: SparkSession, path: str, version: int, entry: dict) -> None:
    """One file appears under its final name at once; if the name is taken, nothing changes."""
    fs, make = _files(spark, path)
    fs.mkdirs(make(f"{path}/list"))
    draft, final = make(f"{path}/list/_{uuid.uuid4().hex}"), make(f"{path}/list/{version:08d}.json")
    out = fs.create(draft, False)
    try:
        out.write(json.dumps(entry, ensure_ascii=True).encode("ascii"))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise PublishConflict(f"{path}: version {version} exists already")


def publish_partitions(df: DataFrame, path: str, partition: str, counts: dict[str, Column] | None = None) -> dict:
    """Replace the partitions that `df` holds and keep all others; returns the audit counts of the rows written.

    The counts (n_rows and the aggregates `counts`) are taken while the rows are written, without a second pass. Until
    the last step, which adds one file to the list, the table is as before: a failed write leaves an unlisted folder.
    If another publication was finished meanwhile, PublishConflict is raised and its result stays. A partition is
    replaced by rows, never emptied: without rows nothing changes. Rows with a null partition value are a
    partition as well. Columns may be added by later publications (null in older partitions), not retyped.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in (counts or {}).items()])
    folder = f"part={uuid.uuid4().hex}"
    # input tasks write their own files, so a value that holds most rows is not gathered
    watched.write.partitionBy(partition).parquet(f"{path}/data/{folder}")
    audit = dict(seen.get)
    made = [n for n in _names(spark, f"{path}/data/{folder}") if n.startswith(f"{partition}=")]
    held = _entry(spark, path, known[-1])["partitions"] if known else {}
    if made or not known:
        kinds = df.select(*[c for c in df.columns if c != partition], partition).schema
        entry = {"partition": partition, "schema": kinds.jsonValue(), "partitions": held | dict.fromkeys(made, folder), "audit": {k: str(v) for k, v in audit.items()}}
        if known:
            entry["schema"] = _widened(_entry(spark, path, known[-1])["schema"], entry["schema"])
        _add_entry(spark, path, (known[-1] if known else 0) + 1, entry)
    return audit


def _widened(old: dict, new: dict) -> dict:
    types = {f["name"]: f["type"] for f in old["fields"]}
    changed = [f["name"] for f in new["fields"] if types.get(f["name"], f["type"]) != f["type"]]
    if changed:
        raise ValueError(f"columns {changed} have another type than the published table")
    return old | {"fields": [*old["fields"], *[f for f in new["fields"] if f["name"] not in types]]}


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of its last publication, or of an earlier one. Filters on the partition column prune folders."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{path}: no publication" if version is None else f"{path}: no publication {version}")
    entry = _entry(spark, path, known[-1] if version is None else version)
    schema = StructType.fromJson(entry["schema"])
    if not entry["partitions"]:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{folder}/{name}" for name, folder in sorted(entry["partitions"].items())]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)
