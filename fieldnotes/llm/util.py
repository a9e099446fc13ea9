"""Helpers shared by the operators: tables, lineage cuts, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.session import scratch_path

#: A word: a run of characters other than space and U+0009 to U+000D. ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``frames`` is called so (in any case of letters)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


class Shared:
    """A broadcast object of bounded size. It is shipped with its class, so executors need not have this package."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @cached_property
    def value(self) -> object:
        value = cloudpickle.loads(self.data.value)
        self.data = None  # the worker keeps the object, not its bytes as well
        return value


def id_hash(col: Column) -> Column:
    """crc32 of an id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text (one row at least), so that work per slice is bounded."""
    for batch in batches:
        col = batch.column(text)
        start, held = 0, 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v), as (node, root): the smallest node of each component.

    Union-find by alternating large-star and small-star steps: each node hangs
    its larger neighbours, then its smaller ones, under the smallest node it
    sees. A step is one partial aggregation (the smallest neighbour) and one
    equi-join, so a hub with very many neighbours is folded before the shuffle
    and split as a skewed join; no neighbour list is ever collected. Each round
    is written to the shared folder, and the rounds end when one changes
    nothing. Self loops and repeated edges are harmless; nodes without an edge
    to another node do not appear. No edges give no rows.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def step(e: DataFrame) -> DataFrame:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()  # u hangs under v < u
        low = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = cut(edges.select("u", "v").where("u <> v").distinct(), name)
    was = state(e)
    for _ in range(most_rounds):
        if not was[0]:
            break
        e = cut(step(e), name)
        now = state(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components: no fixed point")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


@dataclass
class KeyFilter:
    """A Bloom filter of 64-bit keys with a fixed number of bits, whatever the number of keys.

    It only spares shuffles: rows that it lets pass by mistake go through the exact join that follows, and
    with far more keys than bits it lets all pass.
    """

    words: np.ndarray

    HASHES = 3

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        bits = np.uint64(64 * len(self.words) - 1)
        k = keys.view(np.uint64)
        left = np.arange(len(k))
        for i in range(self.HASHES):  # most keys that are not held fail the first time
            at = k[left] if i == 0 else k[left] + np.uint64(i) * ((k[left] >> np.uint64(32)) | np.uint64(1))
            at = at & bits
            left = left[((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)]
        ok = np.zeros(len(k), bool)
        ok[left] = True
        return ok


def key_filter(keys: DataFrame, log_bits: int = 24) -> KeyFilter:
    """The filter of the one long column of ``keys``; it must be a well mixed hash."""
    k, bits = F.col(keys.columns[0]), 1 << log_bits
    step = F.shiftrightunsigned(k, 32).bitwiseOR(F.lit(1))
    at = F.explode(F.array(*[(k + F.lit(i).cast("long") * step).bitwiseAND(F.lit(bits - 1)) for i in range(KeyFilter.HASHES)]))
    hits = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)  # the driver gets at most this many words
    words[hits.column("word").to_numpy()] = hits.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return KeyFilter(words)
