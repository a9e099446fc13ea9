"""Incremental ingest as Structured Streaming jobs over landed API pages.

* ``ingest_available_now``: every landed page not seen before, run to
  completion (``trigger(availableNow=True)``); each micro-batch appends the
  copies that the log does not hold yet, inside ``foreachBatch``, so a batch
  replayed after a failure appends nothing twice.
* ``forget_repeats`` keeps the copies of the last while in the state store, so
  that pages pulled again soon after never reach the log. Its event time is the
  time of the micro-batch, which never runs backwards: no row is late, none is
  dropped for the age of its observation, and the state holds what arrived within
  the horizon only. A copy that comes again after it has been forgotten is
  settled by the anti-join with the log.
* ``read_log`` gives one copy per row id, the smallest. Which micro-batch
  brought a copy first does not matter, and no id is ever dropped for its age.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.operators.incremental import MONTH, dedupe_by_key, table_exists, with_month, with_month_schema
from fieldnotes.schemas import RAW_API, RAW_OBSERVATION
from fieldnotes.session import SENT, kept, sent, write_folders
from fieldnotes.sources.api_pages import explode_results, flatten_results


def page_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_API)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(landing)


def observation_stream(spark: SparkSession, landing: str, loaded_on: dt.date,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    pages = page_stream(spark, landing, max_files_per_trigger)
    return flatten_results(explode_results(pages), loaded_on)


COPY = "_copy"


def forget_repeats(rows: DataFrame, remember: str) -> DataFrame:
    """The stream without whole-row copies that arrived within ``remember`` (an interval text) before."""
    rows = rows.withColumn("_arrived", F.current_timestamp()).withColumn(COPY, F.xxhash64(*RAW_OBSERVATION.names))
    return rows.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["id", COPY]).drop("_arrived", COPY)


def fresh_copies(rows: DataFrame, target: str) -> DataFrame:
    """The copies (whole rows) of the stored table ``rows`` that are not in the log at ``target``, each once.

    Copies are told by their hashes first, so rows are compared and moved only where a hash comes
    again. The hashes of a batch are sent to the log if they are at most ``SENT`` (``session``); the log is
    partitioned by the month of ``updated_at``, which is part of the row id, so the batch's months are read only.
    """
    spark, names = rows.sparkSession, RAW_OBSERVATION.names
    rows = with_month(rows).withColumn(COPY, F.xxhash64(*names))
    again = kept(rows.groupBy(COPY).count().where("count > 1").select(COPY), "again")
    n = again.count()
    if n > SENT:
        rows = rows.distinct()
    elif n:
        again = F.broadcast(again)
        rows = rows.join(again, COPY, "left_anti").unionByName(rows.join(again, COPY, "left_semi").distinct())
    if table_exists(spark, target):
        stored = with_month(spark.read.schema(with_month_schema(RAW_OBSERVATION)).parquet(target))
        stored = stored.select(MONTH, "id", F.xxhash64(*names).alias(COPY))
        asked = sent(kept(rows.select(MONTH, COPY), "asked"))
        known = sent(kept(stored.join(asked, [MONTH, COPY], "left_semi"), "known"))
        rows = rows.join(known, [MONTH, "id", COPY], "left_anti")
    return rows.drop(COPY)


def merge_batch(target: str):
    """``foreachBatch`` body: append the copies (whole rows) of the batch that are not stored."""
    def run(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001 - epoch kept for the signature
        write_folders(fresh_copies(kept(batch, "batch"), target), target, "append", MONTH)
    return run


def ingest_available_now(spark: SparkSession, landing: str, target: str, checkpoint: str, loaded_on: dt.date,
                         max_files_per_trigger: int | None = None, remember: str | None = None) -> list:
    """Land everything new in the log at ``target``; the progress reports of the run. With ``remember`` repeats within it are forgotten first."""
    rows = observation_stream(spark, landing, loaded_on, max_files_per_trigger)
    if remember:
        rows = forget_repeats(rows, remember)
    query = rows.writeStream.foreachBatch(merge_batch(target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return list(query.recentProgress)


def dedupe_stream(spark: SparkSession, landing: str, target: str, checkpoint: str, loaded_on: dt.date,
                  max_files_per_trigger: int | None = None, remember: str = "1 hour") -> DataFrame:
    """Land the stream in the log at ``target`` and return it with one copy per row id, whatever the age of the rows."""
    ingest_available_now(spark, landing, target, checkpoint, loaded_on, max_files_per_trigger, remember)
    return read_log(spark, target)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The smallest copy of every row id in the log."""
    return dedupe_by_key(spark.read.schema(with_month_schema(RAW_OBSERVATION)).parquet(path).select(*RAW_OBSERVATION.names))


__all__ = ["ingest_available_now", "dedupe_stream", "forget_repeats", "observation_stream", "read_log"]
