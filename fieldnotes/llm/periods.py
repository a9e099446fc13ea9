"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and at least ``max(MIN_WORDS, MIN_EXPONENT * q)`` words that no neighbouring
word extends. All runs of a text are found as follows, many texts at a time:

1. Factors of one word are named by sorting; those of ``2 w`` words by sorting the
   pairs of names of their halves. A factor that occurs once in its text gets no name:
   no longer factor around it recurs, so names get few after a level or two of
   ordinary prose.
2. At width w each named factor has its next occurrence in the text. Next occurrences
   at a distance d <= w lie within a window of twice the factor's length, so they form
   arithmetic progressions of difference d: it proposes the period d.
3. Neighbouring places with one d make a stretch; the words of a stretch equal those d
   further on up to the end of its last factor, and no further on either side. So the
   stretch is the extended run, its length that of the stretch plus d. If it has room
   for d + w words then d is its smallest period: a smaller one would be the distance
   of the next occurrence.
4. A run is found at each width from its period to its length less its period; it is
   kept once.

In ``collapsed`` texts a word is dropped if a run contains it after that run's first
period; the words that stay are joined by one space.

Defined cases: words are those of ``WORD``; NULL and empty texts have none, no run and
an empty collapsed text; repeated rows get equal rows; ids are returned as they are,
NULL too; an empty table gives no rows; other columns are ignored. Whole texts are
taken, in slices of bounded bytes (a longer text is a slice of its own); the factors'
names take a few longs a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import WORD, id_hash, slices, table

MIN_WORDS = 6
MIN_EXPONENT = 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def named(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the keys at the places ``at``: places and names of those that occur twice or more (by name, then place), and each's
    distance to the next place of its name (0: none), with the number of names."""
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    same = np.zeros(len(key) + 1, bool)  # as the key before
    same[1:-1] = key[1:] == key[:-1]
    twice = same[:-1] | same[1:]
    first = ~same[:-1][twice]
    at = at[twice]
    name = np.cumsum(first) - 1
    gap = np.zeros(len(at), np.int64)
    gap[:-1] = np.where(first[1:], 0, at[1:] - at[:-1])
    return at, name, gap, np.int64(first.sum())


def stretches(at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, last place and distance of each stretch of neighbouring places with one distance."""
    order = np.argsort(at)
    at, gap = at[order], gap[order]
    new = np.ones(len(at) + 1, bool)
    new[1:-1] = (at[1:] != at[:-1] + 1) | (gap[1:] != gap[:-1])
    return at[new[:-1]], at[new[1:]], gap[new[:-1]]


def runs_of(code: np.ndarray, size: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (text, start, length, period), in order, of all runs in texts of ``size`` words each, ``code`` being all their words."""
    end = np.cumsum(size)
    text = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(code))
    key = text * (code.max(initial=0) + 1) + code
    names = np.full(len(code), -1, np.int64)
    found, width = [np.zeros((0, 3), np.int64)], 1
    while len(at):
        at, name, gap, many = named(key, at)
        near = (gap > 0) & (gap <= width)
        first, last, period = stretches(at[near], gap[near])
        length = last - first + width + period
        long = length >= np.maximum(min_words, min_exponent * period)
        found.append(np.stack([first, length, period], 1)[long])
        # factors of twice the width: both halves have a name, within one text
        names[:] = -1
        names[at] = name
        inside = at + 2 * width <= end[text[at]]
        at, name = at[inside], name[inside]
        after = names[at + width]
        at, key = at[after >= 0], (name * many + after)[after >= 0]
        width *= 2
    start, length, period = np.unique(np.concatenate(found), axis=0).T
    return np.stack([text[start], start - (end - size)[text[start]], length, period], 1)[np.lexsort((period, start))]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, one text after another, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # at the six characters that are in no word
    parts = lists.flatten()
    full = pc.binary_length(parts).to_numpy() > 0
    upto = np.append(0, np.cumsum(full))
    offsets = lists.offsets.to_numpy()
    return parts.filter(pa.array(full)), np.diff(upto[offsets - offsets[0]])


def collapse(words: pa.Array, size: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The texts without the words that a run contains after its first period."""
    begin = np.cumsum(size) - size
    step = np.zeros(len(words) + 1, np.int64)
    text, start, length, period = runs.T
    np.add.at(step, begin[text] + start + period, 1)
    np.add.at(step, begin[text] + start + length, -1)
    stays = np.cumsum(step[:-1]) == 0
    offsets = np.append(0, np.cumsum(stays))[np.append(begin, len(words))]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words.filter(pa.array(stays))), " ")


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs by start, then period, and its text without their repeats.

    ``min_exponent`` must be 3 or more: only then every run has room for a factor of its period and the next one.
    """
    if min_exponent < 3:
        raise ValueError("runs of less than three periods are not found at all widths")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, size = words_of(b.column("text"))
            code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
            found = runs_of(code, size, min_words, min_exponent)
            fields = [pa.array(x.copy()) for x in found.T[1:]]
            offsets = np.append(0, np.cumsum(np.bincount(found[:, 0], minlength=len(size)))).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), runs, collapse(words, size, found)], ["doc_id", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, collapsed string")


def highest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts whose id's hash is divisible by ten repeat, from a place and with a period that follow from the hash."""
    rows = docs.select("doc_id", "text", id_hash(F.col("doc_id")).alias("h")).withColumn("g", F.expr("h div 10"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    # the lambda has its arguments computed once
    at = F.transform(F.array(F.struct(words.alias("w"), F.col("g"))), lambda s: F.struct(s["w"].alias("w"), F.pmod(s["g"], F.size(s["w"])).alias("a"), s["g"].alias("g")))
    at = F.transform(at, lambda s: F.struct(s["w"].alias("w"), s["a"].alias("a"), (1 + F.floor((F.size(s["w"]) - s["a"]) / (3 + s["g"] % 8))).alias("p")))
    text = F.transform(at, lambda s: F.array_join(F.transform(s["w"], lambda x, i: F.when(i < s["a"], x).otherwise(F.get(s["w"], s["a"] + (i - s["a"]) % s["p"]))), " "))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("text").rlike(WORD), F.get(text, F.lit(0))).otherwise(F.col("text")).alias("text"))


def op12_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some of which are made to repeat: their number, the one of greatest exponent, and digests."""
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents"))).withColumn("top", highest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.transform(lines, lambda x: F.concat(x, F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
