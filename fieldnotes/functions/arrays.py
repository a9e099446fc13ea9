"""Array parsing and 1-based, null-safe element access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_int_array(col: Column | str) -> Column:
    """``'{1,2}'::INTEGER[]``: braces trimmed, split on commas, cast each."""
    body = F.btrim(F.trim(_c(col)), F.lit("{}"))
    parts = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, ","))
    return F.transform(parts, lambda x: F.trim(x).cast("int"))


def split_text(col: Column | str, sep: str = ",") -> Column:
    """``STRING_TO_ARRAY(text, sep)``."""
    return F.split(_c(col), sep, -1)


def coordinates(col: Column | str, precision: int = 12, scale: int = 6) -> Column:
    """``STRING_TO_ARRAY(location, ',')::NUMERIC[]`` with a fixed decimal type.

    A part that is not a number raises under ANSI mode, as the database does.
    """
    return split_text(col).cast(f"array<decimal({precision},{scale})>")


def array_get(arr: Column | str, index_1based: int) -> Column:
    """SQL subscript ``a[i]``: 1-based, NULL when out of range."""
    return F.get(_c(arr), index_1based - 1)
