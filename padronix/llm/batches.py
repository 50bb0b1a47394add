"""Arrow-batch helpers: append columns computed from a text column, walk runs of equal keys, use the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one Arrow batch; with texts of 1 MB a batch then holds 0.5 GB at most.
BATCH_ROWS = 500

Compute = Callable[[pa.Array], list]

# What a Python worker keeps from task to task, by one kind of task; tasks of other kinds let it go.
KEPT: dict = {}


def free_worker() -> None:
    """A function of the module, so that tasks call the worker's own: a dict would travel with them as a copy."""
    KEPT.clear()


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by rows only; texts are long, so the default of 10,000 rows is too many."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def append_columns(docs: DataFrame, text: str, fields: T.StructType, start: Callable[[], Compute], keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with `fields` computed from the text column, batch by batch.

    `start()` runs once in each task and returns a function from the batch's texts, as an Arrow array of
    binary values (UTF-8, null where the text is null), to one list or array per field. A column of `docs` that has
    the name of a field is replaced, as `withColumn` does.
    """
    bounded_batches(docs.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    passed = [docs[c] for c in kept] + [docs[text].cast("binary").alias("__text")]
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in kept] + list(fields.fields))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        compute = start()
        types = None
        for batch in batches:
            if types is None:
                types = [arrow_type(f.dataType) for f in fields]
            columns = compute(batch.column(len(kept)))
            made = [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + made, names=[f.name for f in schema])

    return docs.select(*passed).mapInArrow(run, schema)


def kept_rows(docs: DataFrame, text: str, mark: Callable[[DataFrame], DataFrame], condition: Column) -> DataFrame:
    """Rows of `docs` for which a column that `mark` adds to (__row, text) holds; names of `docs` can't clash with it."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[text].alias("text"))
    return mark(rows).where(condition).select("__row.*")


def arrow_type(kind: T.DataType) -> pa.DataType:
    """Arrow's type for the simple types and lists that the operators return."""
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind])
    return {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(),
    }[kind.simpleString()]


def key_runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[dict]]]:
    """(key values, rows) of every run of equal leading columns, for a partition sorted by them."""
    held: list[dict] = []
    key = None
    for batch in batches:
        names = batch.schema.names[:keys]
        for row in batch.to_pylist():
            now = tuple(row[n] for n in names)
            if held and now != key:
                yield key, held
                held = []
            key = now
            held.append(row)
    if held:
        yield key, held


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, under the folder that all machines share.

    That is spark.checkpoint.dir. Only a local session, as in tests, may lack the setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/padronix-{uuid.uuid4().hex}"


def materialize(table: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table below a shared folder and read it back, which cuts its lineage there."""
    path = f"{folder}/{name}"
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
