"""Parquet tables in parts and versions, with an atomic switch.

A write puts the rows of the parts it touches into a new version folder and then commits
it: one row per part is appended to the table of versions, a single small file that
Spark's commit protocol makes visible at once or not at all. Readers take the newest
committed version of every part, so they see all of a write or nothing of it; a run that
dies before the commit leaves a folder that nobody reads and the next run overwrites.
Nothing is copied: each part is written once, and the version before stays readable until
``vacuum``.

The driver holds the list of versions and parts (a few numbers each); the number of parts
is a parameter and ``vacuum`` keeps the versions few.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.operators.incremental import table_exists
from fieldnotes.session import write_folders

PART = "_part"
#: ``rows`` says whether a part has any: their number, or 1.
VERSIONS = T.StructType([T.StructField("version", T.LongType()), T.StructField("part", T.IntegerType()),
                         T.StructField("rows", T.LongType()), T.StructField("stamp", T.StringType())])

EMPTIED = T.StructType([T.StructField("version", T.LongType())])


def part_of(parts: int, *keys: str) -> Column:
    """The part of a row among ``parts``, by a hash of its keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty one if there is no such path."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class PartTable:
    """A table under ``path`` whose rows carry their part in the column ``PART`` when they are written."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list:
        """(version, part, rows, stamp) of all that was committed."""
        return sorted(set(read_if_there(self.spark, f"{self.path}/versions", VERSIONS).collect()), key=lambda v: v.version)

    def newest(self) -> dict[int, object]:
        """The newest committed version of every part."""
        return {v.part: v for v in self.versions()}

    def write(self, df: DataFrame, stamps: dict[int, str] | None = None) -> int:
        """``df`` as the new version of its parts, and of those in ``stamps`` (empty if ``df`` has no row there); returns its number."""
        number = max((v.version for v in self.versions()), default=0) + 1
        self.write_files(df, number)
        schema = T.StructType([*(f for f in df.schema if f.name != PART), T.StructField(PART, T.IntegerType())])
        counts = self.spark.read.schema(schema).parquet(self.folder(number)).groupBy(PART).count().collect()  # a row per part
        self.commit(number, dict.fromkeys(stamps or (), 0) | {r[0]: r[1] for r in counts}, stamps or {})
        return number

    def write_files(self, df: DataFrame, number: int) -> None:
        write_folders(df, self.folder(number), "overwrite", PART)

    def commit(self, number: int, rows: dict[int, int], stamps: dict[int, str]) -> list:
        made = [(number, p, n, stamps.get(p)) for p, n in sorted(rows.items())]
        if made:
            self.spark.createDataFrame(made, VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return [T.Row(version=v, part=p, rows=n, stamp=s) for v, p, n, s in made]

    def folder(self, version: int) -> str:
        return f"{self.path}/data/version={version}"

    def read(self, schema: T.StructType, parts: Iterable[int] | None = None, every_version: bool = False) -> DataFrame:
        """The rows of ``parts`` (all if None): of their newest versions, or of all versions of a table that only grows."""
        wanted = None if parts is None else set(parts)
        held = self.versions() if every_version else self.newest().values()
        return self.rows_of([v for v in held if wanted is None or v.part in wanted], schema)

    def rows_of(self, held: Iterable, schema: T.StructType) -> DataFrame:
        paths = sorted(f"{self.folder(v.version)}/{PART}={v.part}" for v in held if v.rows)
        plain = T.StructType([f for f in schema if f.name != PART])
        return self.spark.read.schema(plain).parquet(*paths) if paths else self.spark.createDataFrame([], plain)

    def replace(self, df: DataFrame) -> DataFrame:
        """``df`` as the whole table in one part; the stored rows. The version before stays readable, older ones go."""
        held = self.versions()
        number = max((v.version for v in held), default=0) + 1
        self.write_files(df.withColumn(PART, F.lit(0)), number)
        made = self.commit(number, {0: int(table_exists(self.spark, f"{self.folder(number)}/{PART}=0"))}, {})
        self.vacuum(2, [*held, *made])
        return self.rows_of(made, df.schema)

    def vacuum(self, keep: int = 1, versions: list | None = None) -> int:
        """Empties the folders of versions that are among the ``keep`` newest of no part; returns how many."""
        held: dict[int, list[int]] = {}
        for v in self.versions() if versions is None else versions:
            held.setdefault(v.part, []).append(v.version)
        old = {n for numbers in held.values() for n in numbers} - {n for numbers in held.values() for n in numbers[-keep:]}
        old = old - self.emptied() if old else old
        for number in sorted(old):
            self.spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(self.folder(number))
        if old:
            self.spark.createDataFrame([(n,) for n in sorted(old)], EMPTIED).coalesce(1).write.mode("append").parquet(f"{self.path}/emptied")
        return len(old)

    def emptied(self) -> set[int]:
        return {r[0] for r in read_if_there(self.spark, f"{self.path}/emptied", EMPTIED).collect()}
