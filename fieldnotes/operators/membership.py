"""A membership sketch per month of the log: Bloom words that spare the scan of the log.

Each month of the log has a Bloom filter of its ids, stored as rows (month, word, bits).
An append adds rows for its own ids; rows of one word are OR-ed when they are read. A
batch is tested against the words of its months before the log is: ids with a bit missing
are new for certain, only the others go into the exact join. If there are none, no file
of the log is read.

The filter of a month has ``1 << log_bits`` bits at any size; with many more ids than
bits it lets all pass, and the exact join does what it would have done without it. So
``log_bits`` should follow the ids of a month (ten bits each let about 1 in 100 pass).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnotes.operators.incremental import MONTH, dedupe_by_key, with_month
from fieldnotes.session import kept, sent

HASHES = 4
LOG_BITS = 20
WORD_BITS = 63  # the sign bit is not used


def places(key: str, log_bits: int) -> Column:
    """Array of (word, bit) of a key."""
    at = [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(1 << log_bits)) for i in range(HASHES)]
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), (x % WORD_BITS).cast("int"))
    return F.array(*[F.struct(F.floor(x / WORD_BITS).alias("word"), bit(x).alias("bit")) for x in at])


def sketch(rows: DataFrame, key: str = "id", log_bits: int = LOG_BITS) -> DataFrame:
    """(month, word, bits) of the keys of ``rows``, which have their month or ``updated_at``."""
    bits = with_month(rows).select(MONTH, F.explode(places(key, log_bits)).alias("p"))
    return bits.groupBy(MONTH, F.col("p.word").alias("word")).agg(F.bit_or("p.bit").alias("bits"))


def maybe_stored(batch: DataFrame, words: DataFrame, key: str = "id", log_bits: int = LOG_BITS) -> DataFrame:
    """Rows of ``batch`` whose key may be in the log: all its bits are set in its month's words.

    Only words of the batch's months are folded, and only rows of months that have words are
    asked for. They are asked for by the hash of their key, of which their bits are a function.
    """
    months = kept(batch.select(MONTH).distinct(), "months")
    words = kept(words.join(sent(months), MONTH, "left_semi").groupBy(MONTH, "word").agg(F.bit_or("bits").alias("bits")), "words")
    batch = batch.join(sent(kept(words.select(MONTH).distinct(), "months")), MONTH, "left_semi")
    asked = batch.select(MONTH, F.xxhash64(key).alias("asked"), F.explode(F.array_distinct(places(key, log_bits))).alias("p")).select(MONTH, "asked", "p.word", "p.bit")
    missing = asked.join(sent(words), [MONTH, "word"], "left").where(F.coalesce(F.col("bits").bitwiseAND(F.col("bit")), F.lit(0)) == 0)
    missing = missing.select(F.col(MONTH).alias("_month"), "asked").distinct()
    return batch.join(missing, (F.col(MONTH) == F.col("_month")) & (F.xxhash64(key) == F.col("asked")), "left_anti")


def new_rows(batch: DataFrame, stored: DataFrame, words: DataFrame, key: str = "id", log_bits: int = LOG_BITS) -> DataFrame:
    """Rows of ``batch`` whose key is not stored, deduplicated; the log ``stored`` is read only if the sketch does not rule it out.

    Rows with a NULL key are new, as in an anti-join. The batch should be a stored table: it is read for the test, then again.
    """
    deduped = with_month(dedupe_by_key(batch, key))
    maybe = kept(maybe_stored(deduped, words, key, log_bits).select(MONTH, key).where(F.col(key).isNotNull()), "maybe")
    if maybe.isEmpty():
        return deduped.select(*batch.columns)
    maybe = sent(maybe)
    known = with_month(stored).select(MONTH, key).join(maybe, [MONTH, key], "left_semi").select(key).distinct()
    asked = deduped.join(maybe, [MONTH, key], "left_semi").join(known, key, "left_anti")
    return deduped.join(maybe, [MONTH, key], "left_anti").unionByName(asked).select(*batch.columns)
