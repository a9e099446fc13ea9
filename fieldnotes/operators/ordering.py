"""Proof that a frame's rows come in an order, without bringing them together.

A sorted frame is a sequence of partitions. Its rows are in order if in every partition
each row is not before the one above it, and each partition's first row is not before the
last row of the partition above that has rows. The first part is a window inside each
partition, the second one a row per partition.

Defined cases: equal keys are in any order; NULL keys come last; an empty frame is in
order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def before(x: str, y: str) -> Column:
    """Whether key ``x`` comes strictly before ``y``, NULL last."""
    return F.coalesce(F.col(x) < F.col(y), F.col(x).isNotNull() & F.col(y).isNull())


def order_violations(df: DataFrame, key: Column | str) -> DataFrame:
    """One row: num_rows, and num_violations of the order by ``key`` in the order that ``df`` has."""
    key = F.col(key) if isinstance(key, str) else key
    placed = df.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"), key.alias("k"))
    return violations(placed)


def violations(placed: DataFrame) -> DataFrame:
    """The same of rows (part, pos, k): partitions by ``part``, in each the rows by ``pos``."""
    inside = Window.partitionBy("part").orderBy("pos")
    rows = placed.withColumn("above", F.lag(F.struct("k")).over(inside))
    rows = rows.withColumn("above_k", F.col("above.k"))
    parts = rows.groupBy("part").agg(
        F.count("*").alias("n"), F.count_if(F.col("above").isNotNull() & before("k", "above_k")).alias("bad"),
        F.min_by(F.struct("k"), "pos").alias("first"), F.max_by(F.struct("k"), "pos").alias("last"))
    # a row per partition; lag over NULL part puts them all in one, as few as there are partitions
    edges = parts.withColumn("above", F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("part")))
    edges = edges.withColumn("x", F.col("first.k")).withColumn("y", F.col("above.k"))
    bad = F.coalesce(F.sum(F.col("bad") + F.when(F.col("above").isNotNull() & before("x", "y"), 1).otherwise(0)), F.lit(0))
    return edges.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"), bad.cast("long").alias("num_violations"))
