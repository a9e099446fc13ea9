"""Exact distinct counts that are kept up to date from increments, as bitmaps.

The ids of a group are a set of bits: one bitmap per (group, block of 32768 neighbouring
ids). Bitmaps of the same block are merged by OR, so the counts of a log are those of the
stored state and the state of the new rows, whatever ids they share; no stored row is
read again. Ids that are given out in order fall into few blocks per period.

Defined cases: NULL ids are not counted, as in ``COUNT(DISTINCT)``: a group of nothing
else has the count 0 and keeps its row; NULL group keys are a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_of(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(keys, block, bits) of the ids of ``df``; block and bits are NULL for ids that are NULL."""
    i = F.col(id_col).cast("long")
    rows = df.select(*keys, F.bitmap_bucket_number(i).alias("block"), F.bitmap_bit_position(i).alias("bit"))
    return rows.groupBy(*keys, "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The state of both: blocks that only one has are taken as they are."""
    return a.unionByName(b).groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(state: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, ``name``): the number of different ids of each group."""
    n = F.when(F.col("block").isNotNull(), F.bitmap_count("bits")).otherwise(F.lit(0))
    return state.groupBy(*keys).agg(F.sum(n).alias(name))
