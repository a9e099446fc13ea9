"""Strict and lenient reading: rejected records with the reason, beside the good ones.

Strict reading (``staging.stage_observations``, ``api_pages.parse_pages``) raises at a value
that cannot be cast and passes a corrupt page as NULLs. Lenient reading splits its input:
what can be staged is staged by the strict code, the rest is returned with the reason.

Defined cases: a record with several faults has the first reason in the order of
``REASONS``; NULL values are no faults; a page that is no JSON object, or holds a value
of another type, is rejected whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.functions import split_text
from fieldnotes.operators import staging
from fieldnotes.params import Params
from fieldnotes.schemas import RAW_API

CORRUPT = "_corrupt_record"


def castable(parts: Column, kind: str) -> Column:
    """Whether every part is NULL or a value of ``kind``; NULL parts are."""
    return F.coalesce(F.forall(parts, lambda x: x.isNull() | x.try_cast(kind).isNotNull()), F.lit(True))


def reason() -> Column:
    """Why a raw row cannot be staged, or NULL."""
    body = F.btrim(F.trim("place_ids"), F.lit("{}"))
    places = F.when(body != "", F.transform(split_text(body), lambda x: F.trim(x)))
    return (F.when(~castable(split_text("location"), "decimal(12,6)"), F.lit("location is not a list of numbers"))
            .when(~castable(places, "int"), F.lit("place_ids is not a list of whole numbers")))


def split_raw(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that can be staged, and the others with their ``reason``."""
    rated = raw.withColumn("reason", reason())
    return rated.where("reason IS NULL").drop("reason"), rated.where("reason IS NOT NULL")


def stage_lenient(raw: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """Staged rows, and the rejected raw rows of the staged period with their ``reason``."""
    good, bad = split_raw(raw)
    return staging.stage_observations(good, params), bad.where(F.col("observed_date") >= F.lit(params.epoch).cast("timestamp_ntz"))


def split_pages(json_text: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed pages, and (value, reason) of the texts that are no page."""
    schema = T.StructType([*RAW_API.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = json_text.select(F.col(col).alias("value"), F.from_json(F.col(col), schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("p"))
    bad = F.col("p").isNull() | F.col(f"p.{CORRUPT}").isNotNull()
    pages = parsed.where(~bad).select(*[F.col(f"p.{f.name}") for f in RAW_API.fields])
    return pages, parsed.where(bad).select("value", F.lit("not a page").alias("reason"))
