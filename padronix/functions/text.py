"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squish(c: Column) -> Column:
    """Trim and collapse every run of whitespace (no-break spaces too) to one space."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def title_case(c: Column) -> Column:
    """Squish, then capitalise each word."""
    return F.initcap(squish(c))


def shorten(c: Column, width: int) -> Column:
    """Cut to `width` characters in total, the last three being dots where text was cut."""
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width - 3), F.lit("..."))).otherwise(c)


def plain(c: Column) -> Column:
    """Lower case without Spanish accents: a key for matching spellings."""
    return F.translate(F.lower(squish(c)), "áéíóúüñ", "aeiouun")


def row_hash(seed: int, *keys: str) -> Column:
    """md5 of the seed and the key columns: a repeatable random order.

    NULL keys count as an empty field, so that every row has a place in the order.
    """
    fields = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *fields))
