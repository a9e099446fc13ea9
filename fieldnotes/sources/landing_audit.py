"""Audit of landed pulls: pages that a pull promised and that never landed.

A pull answers with its total and its page size on every page, and is read page by page
from 1 to ``int(total / per_page) + 1``. What is missing is found as gaps between the
page numbers that landed, with the ends of the range as neighbours, so the pages that
should be there are never listed one by one.

Defined cases: a page that landed twice counts once; of different totals in one pull
(rows were added while it ran) the largest counts; pages without a number or a total are
no evidence and left out; numbers beyond the range change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PULL = ("place_id",)


def missing_pages(pages: DataFrame, pull: tuple[str, ...] = PULL) -> DataFrame:
    """(pull, first_page, last_page, num_pages) of every range of missing pages of every pull."""
    known = pages.where("page IS NOT NULL AND total_results IS NOT NULL AND per_page > 0")
    landed = known.groupBy(*pull, "page").agg(F.max(F.expr("total_results div per_page + 1")).alias("expected"))
    ends = landed.groupBy(*pull).agg(F.max("expected").alias("expected"))
    ends = ends.select(*pull, F.explode(F.array(F.lit(0).cast("long"), F.col("expected") + 1)).alias("page"), "expected")
    rows = landed.select(*pull, F.col("page").cast("long").alias("page"), F.lit(None).cast("long").alias("expected")).unionByName(ends)
    order = Window.partitionBy(*pull).orderBy("page")
    rows = rows.select(*pull, "page", F.max("expected").over(Window.partitionBy(*pull)).alias("expected"), F.lag("page").over(order).alias("before"))
    gaps = rows.where("page - before > 1 AND page <= expected + 1")
    return gaps.select(*pull, (F.col("before") + 1).alias("first_page"), (F.col("page") - 1).alias("last_page"), (F.col("page") - F.col("before") - 1).alias("num_pages"))
