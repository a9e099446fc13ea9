"""Incremental load: high-water mark, key dedupe, anti-join, upsert, append.

Nothing here pulls ids or rows to the driver: the high-water mark stays a
one-row DataFrame, and "not already stored" is a left-anti join. Rows are moved
as little as can be: what the joins need (repeated keys, stored keys) is found
from the key columns and kept in small files, so the rows stay where they are.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.session import SENT, kept, sent, write_folders


def high_water_mark(stored: DataFrame, col: str = "updated_at") -> DataFrame:
    """One row: the latest ``col`` truncated to a day, as ``yyyy-MM-dd`` text
    (NULL when nothing is stored, which means a full load)."""
    return stored.agg(F.date_format(F.max(col), "yyyy-MM-dd").alias("high_water_mark"))


def updated_since(rows: DataFrame, hwm: DataFrame, col: str = "updated_at") -> DataFrame:
    """Rows updated on or after the high-water-mark day; all rows if it is NULL.

    ``hwm`` is a one-row aggregate used as a scalar subquery: Spark evaluates
    it once and compares every row with the value, with no join.
    """
    since = F.to_date(hwm.select("high_water_mark").scalar()).cast("timestamp_ntz")
    return rows.where(since.isNull() | (F.col(col) >= since))


#: Partition column of the log: the first day of the month of ``updated_at``, which the row id contains.
MONTH = "updated_month"


def with_month(rows: DataFrame) -> DataFrame:
    """``rows`` with the month of their version; rows without one share the first month there is."""
    month = F.coalesce(F.trunc(F.to_date("updated_at"), "MM"), F.lit("0001-01-01").cast("date"))
    return rows if MONTH in rows.columns else rows.withColumn(MONTH, month)


def with_month_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])


def dedupe_by_key(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per ``key``: the smallest row (all columns compared in order; the one NULL key is a key like others).

    Hashes of the keys are counted first, eight bytes a row, and those that occur more
    than once are kept in a file. Only rows with such a hash are shuffled, and compared by
    the key itself; the others pass as they are. ``df`` is read twice: a stored table is best.
    The hashes are sent to the rows. If they are too many for that, all rows are dealt out by key, once.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    again = kept(df.select(F.xxhash64(key).alias("_again")).groupBy("_again").agg(F.count("*").alias("_n")).where("_n > 1").select("_again"), "again")
    n = again.count()
    if not n:
        return df
    smallest = F.min(F.struct(*others)).alias("_row")
    if n > SENT:
        return df.repartition(key).groupBy(key).agg(smallest).select(key, "_row.*").select(*df.columns)
    again, same = F.broadcast(again), F.xxhash64(key) == F.col("_again")
    once, many = df.join(again, same, "left_anti"), df.join(again, same, "left_semi")
    first = many.groupBy(key).agg(smallest).select(key, "_row.*")
    return once.unionByName(first.select(*df.columns))


def known_keys(batch: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """The keys of ``batch`` that are stored, each once, kept in a file; a join sends them to the rows of the batch if they are few.

    The log only grows while a batch stays small, so the build side is the batch's
    keys. If the stored side has the month of the row version (``MONTH``), it is
    joined as well, so only the batch's months are read.
    """
    on, keys = [key], batch.select(key)
    if MONTH in stored.columns:
        on, keys = [MONTH, key], with_month(batch).select(MONTH, key)
    return sent(kept(stored.select(*on).join(keys, on, "left_semi").select(key).distinct(), "known"))


def new_rows(batch: DataFrame, stored: DataFrame | None, key: str = "id") -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet (deduped within the batch): an anti-join with the keys that are."""
    deduped = dedupe_by_key(batch, key)
    return deduped if stored is None else deduped.join(known_keys(deduped, stored, key), key, "left_anti")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed merge: every update row, plus target rows whose key has no update."""
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return updates.unionByName(kept)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when there is a table's folder at ``path``."""
    try:
        spark.read.schema("any string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty frame with its schema on the first run."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append sink (Parquet)."""
    if partition_by:
        write_folders(df, path, "append", *partition_by)
    else:
        df.write.mode("append").option("compression", "zstd").parquet(path)


def load_increment(spark: SparkSession, batch: DataFrame, path: str, schema: T.StructType,
                   key: str = "id") -> int:
    """Append the new rows of ``batch`` to the table at ``path``, partitioned by ``MONTH``; return how many.

    The batch is written to a staging folder first, so it is parsed once. The keys that are
    stored already are found before the append and kept in a file, so the target is not read while it is written.
    """
    staging = f"{path.rstrip('/')}_staging_batch"
    batch.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    batch = dedupe_by_key(spark.read.schema(schema).parquet(staging), key)
    n = batch.count()
    if table_exists(spark, path):
        known = known_keys(batch, spark.read.schema(with_month_schema(schema)).parquet(path), key)
        n -= known.count()
        batch = batch.join(known, key, "left_anti")
    if n:
        append(with_month(batch), path, partition_by=[MONTH])
    return n
