"""Conversion, recoding and guarded arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    """Text to double; bad text gives NULL, as do Java's number suffixes ("12d", "3f")."""
    text = F.trim(c.cast("string"))
    suffixed = F.substring(text, -1, 1).isin("d", "D", "f", "F") & ~F.lower(F.substring(text, -3, 3)).eqNullSafe("inf")
    return F.when(~suffixed, text.try_cast("double"))


def to_int(c: Column) -> Column:
    """Text to integer, dropping any fraction; bad text and values out of range give NULL."""
    return to_double(c).try_cast("int")


def is_missing(c: Column, type_name: str = "") -> Column:
    """NULL, and NaN for floating point columns."""
    return (c.isNull() | F.isnan(c)) if type_name in ("double", "float") else c.isNull()


def first_match(c: Column, rules: Sequence[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """Value of the first regular expression found in `c`; `c` itself where none is."""
    out = None
    for pattern, value in rules:
        out = F.when(c.rlike(pattern), value) if out is None else out.when(c.rlike(pattern), value)
    return out.otherwise(c if otherwise is None else otherwise)


def recode(c: Column, levels: Mapping[Any, Sequence[Any]], default: Any = None) -> Column:
    """Map listed values to their level; anything else (NULL too) to `default`."""
    out = None
    for level, members in levels.items():
        out = F.when(c.isin(*members), level) if out is None else out.when(c.isin(*members), level)
    return out.otherwise(F.lit(default))


def three_way(c: Column, low: float, high: float, labels: Sequence[str], upper_closed: bool) -> Column:
    """Low / middle / high label. `upper_closed` puts a value equal to `high` in the high class.

    NULL takes the label of the last branch: the middle one, or with `upper_closed` the high one.
    """
    below, middle, above = labels
    if upper_closed:
        return F.when(c < low, below).when(c < high, middle).otherwise(above)
    return F.when(c < low, below).when(c > high, above).otherwise(middle)


def safe_ratio(n: Column, d: Column, default: float = 0.0) -> Column:
    """n/d where d > 0, `default` where d <= 0, NULL where d is NULL."""
    return F.when(d.isNull(), F.lit(None).cast("double")).when(d > 0, n / d).otherwise(F.lit(default))


def finite_or(c: Column, default: float = 0.0) -> Column:
    """Replace NULL, NaN and the infinities."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(c)


def pct(n: Column, total: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL for an empty total."""
    return F.round(F.try_divide(n * F.lit(100.0), total), digits)


def equal_width_bin(c: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin over [low, high]; the top edge belongs to the last bin."""
    position = F.floor((c - low) / ((high - low) / bins)).cast("int")
    return F.when(high > low, F.greatest(F.lit(0), F.least(F.lit(bins - 1), position))).when(c.isNotNull(), F.lit(0))
