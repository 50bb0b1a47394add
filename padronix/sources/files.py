"""Reading raw delimited files, and reading and writing tables, reports and their manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.operators.quality import stack_rows

ENCODINGS = ("UTF-8", "ISO-8859-1")


def csv_options(delimiter: str, multi_line: bool) -> dict:
    return {
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "nullValue": "NA",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "mode": "PERMISSIVE",
    }


def _read_csv(spark: SparkSession, path: str, encoding: str, delimiter: str, multi_line: bool) -> DataFrame:
    # every column is text: types are forced later, where bad values can be counted
    return spark.read.options(header=True, inferSchema=False, encoding=encoding, **csv_options(delimiter, multi_line)).csv(path)


def _has_broken_text(df: DataFrame) -> bool:
    """Whether decoding left a replacement character, in a column name or in a value."""
    mark = "�"
    if any(mark in c for c in df.columns):
        return True
    found = F.lit(False)
    for c in df.columns:
        found = found | F.coalesce(F.col(f"`{c}`").contains(mark), F.lit(False))
    return bool(df.where(found).limit(1).count())


def read_csv_safe(
    spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS, delimiter: str = ",", multi_line: bool = True
) -> DataFrame:
    """Read a delimited file with a header under the first encoding that decodes cleanly.

    A doubled quote inside quotes is a quote. With `multi_line` a quoted field may hold line breaks, and a file is
    read by one task; `quoted.read_quoted_csv` splits such files among tasks. Files without such fields are split
    with `multi_line` off.
    "NA" and empty fields become NULL. A missing file raises FileNotFoundError; text that no listed
    encoding can decode raises UnicodeError.
    """
    for encoding in encodings:
        try:
            df = _read_csv(spark, path, encoding, delimiter, multi_line)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                raise FileNotFoundError(path) from error
            raise
        if not _has_broken_text(df):
            return df
    raise UnicodeError(f"{path}: none of {list(encodings)} decodes the file")


def load_tables(spark: SparkSession, manifest: Mapping[str, str], **options) -> dict[str, DataFrame]:
    """Read every file of a manifest (name -> path)."""
    return {name: read_csv_safe(spark, path, **options) for name, path in manifest.items()}


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return stack_rows(parts)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a stage's table. Readers that filter on a partition column skip the other folders."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_report(df: DataFrame, path: str, one_file: bool = True) -> None:
    """Write a result table as CSV with a header: one file, or as many as the table has partitions."""
    (df.repartition(1) if one_file else df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.csv(path, header=True, inferSchema=schema is None, quote='"', escape='"', multiLine=True)
