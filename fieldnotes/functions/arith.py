"""Null-safe ratios and truncating integer division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / NULLIF(den, 0)::DOUBLE``: NULL instead of a division by zero."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def integer_delta(change: Column | str, base: Column | str) -> Column:
    """``change / NULLIF(base, 0)`` on integers: truncates toward zero.

    ``a - a % b`` is an exact multiple of ``b`` (``%`` keeps the sign of the
    dividend), so the quotient is exact and equals SQL integer division.
    """
    b = F.nullif(_c(base), F.lit(0))
    a = _c(change)
    return ((a - a % b) / b).cast("int")


def zero_guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """``num::DOUBLE / COALESCE(NULLIF(den, 0), 1)::DOUBLE``."""
    return _c(num).cast("double") / F.coalesce(F.nullif(_c(den), F.lit(0)), F.lit(1)).cast("double")
