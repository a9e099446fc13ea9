"""Surrogate keys and the composite observation row id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical keys:
# the token that stands for NULL inside a surrogate key and the separator
# placed between the key parts.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def _as_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL_TOKEN))


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the null-safe, separator-joined text of ``cols``.

    Timestamps render as ``yyyy-MM-dd HH:mm:ss`` and decimals keep their
    scale, which is the text the SQL cast produces.
    """
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *[_as_text(c) for c in cols]))


def _epoch_text(ts: Column) -> Column:
    """Epoch seconds of a UTC wall-clock timestamp as Python prints a float.

    Whole seconds print with one decimal (``955411200.0``); sub-second values
    print their significant micro digits (``955411200.25``).
    """
    # micros between two wall-clock (NTZ) timestamps: no session time zone involved
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              ts.cast("timestamp_ntz"))
    whole = F.concat((micros / 1_000_000).cast("long").cast("string"), F.lit(".0"))
    exact = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)").cast("string")
    frac = F.regexp_replace(exact, "0+$", "")
    text = F.when(micros % 1_000_000 == 0, whole).otherwise(frac)
    return F.coalesce(text, F.lit("nan"))


def row_id(inaturalist_id: Column | str = "inaturalist_id",
           updated_at: Column | str = "updated_at",
           name: Column | str = "name") -> Column:
    """Observation version id: id text + epoch text + first 3 + last 3 of name.

    A missing name renders as the text ``None`` (so ``Non`` + ``one``), a
    missing timestamp as ``nan``, as the Python job that writes the log does.
    """
    iid = F.col(inaturalist_id) if isinstance(inaturalist_id, str) else inaturalist_id
    upd = F.col(updated_at) if isinstance(updated_at, str) else updated_at
    nm = F.col(name) if isinstance(name, str) else name
    nm = F.coalesce(nm, F.lit("None"))
    return F.concat(
        F.coalesce(iid.cast("string"), F.lit("None")),
        _epoch_text(upd),
        F.substring(nm, 1, 3),
        F.when(F.length(nm) >= 3, F.substring(nm, -3, 3)).otherwise(nm),
    )
