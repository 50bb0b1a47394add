"""Delimited files whose quoted fields hold line breaks, read by many tasks per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from padronix.sources.files import ENCODINGS, csv_options


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the byte range that a task reads (`block`), and their order inside it (`line`)."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
            ((F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2).cast("long").alias("odd"),
        )
    )


def _records(lines: DataFrame) -> DataFrame:
    """Records as one column `record` (bytes), headers left out.

    A line with an odd number of quotes opens or closes a field with line breaks. With `turns` such lines before a
    line in its file, the line starts a record if `turns` is even; an opening line and those up to the closing one
    share the number of the turn. Only these are grouped; a record's lines meet in one task, as any record must.
    """
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("line")
    before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumns({"before": before, "header": (F.row_number().over(inside) == 1) & (F.col("block") == 0)})
    placed = placed.join(blocks, ["file", "block"]).withColumn("turns", F.col("base") + F.col("before"))
    whole = (F.col("turns") % 2 == 0) & (F.col("odd") == 0)
    single = placed.where(whole & ~F.col("header")).select(F.col("value").cast("binary").alias("record"))
    part = F.struct("block", "line", F.hex(F.col("value").cast("binary")).alias("bytes"))
    broken = (
        placed.where(~whole)
        .groupBy("file", (F.col("turns") + (F.col("turns") % 2 == 0).cast("long")).alias("turn"))
        .agg(F.bool_or("header").alias("header"), F.array_sort(F.collect_list(part)).alias("parts"))
        .where(~F.col("header"))
        .select(F.unhex(F.array_join(F.col("parts.bytes"), "0A")).alias("record"))
    )
    return single.unionAll(broken)


def read_quoted_csv(spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS, delimiter: str = ",") -> DataFrame:
    """Rows as `read_csv_safe` with `multi_line` gives them, with every file split among tasks.

    The first pass counts quotes and checks the encoding. If no line has an odd number of quotes, no field holds a line
    break and files are read by lines. Otherwise lines are numbered by the quotes before them in their byte range and
    in the ranges before it, so each record is known from its first line on, wherever a file is cut.

    Every quote must delimit a field or be doubled inside one; a file that leaves a quote open raises ValueError.
    Lines end in LF or CRLF. UTF-8 is checked exactly; another encoding is taken as the first that is listed after it,
    must hold ASCII as it is, and raises where it can't decode. All columns are text.
    """
    try:
        lines = _lines(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    files = lines.groupBy("file").agg(F.sum("odd").alias("n"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    found = files.agg(F.sum("n").alias("n"), F.max_by("file", F.col("n") % 2).alias("file"), F.max(F.col("n") % 2).alias("open"), F.bool_and("utf8").alias("utf8")).first()
    if found["open"]:
        raise ValueError(f"{found['file']}: a quote is left open")
    usable = [e for e in encodings if found["utf8"] or e.upper().replace("-", "") != "UTF8"]
    if not usable:
        raise UnicodeError(f"{path}: none of {list(encodings)} decodes the file")
    options = csv_options(delimiter, multi_line=bool(found["n"]))
    reader = spark.read.options(header=True, inferSchema=False, encoding=usable[0], **options)
    if not found["n"]:
        return reader.csv(path)
    names = reader.csv(path).columns
    schema = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)
    text = F.regexp_replace(F.decode("record", usable[0]), r"\r\z", "")
    rows = _records(lines).select(text.alias("record")).where("record <> ''")
    return rows.select(F.from_csv("record", schema, options).alias("row")).select("row.*")
