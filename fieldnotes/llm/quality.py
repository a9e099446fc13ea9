"""Quality rules: word counts and repeats, then zstandard compression bands.

The base rules reject a text with too few words or too many words inside
repeated windows. The method then compresses the whole text and each fixed chunk of it
and compares the ratios (bytes / compressed bytes) with limits that depend on
the length, since a longer text gives the compressor more to refer to. Above the
upper limit a text is repetitive, below the lower one incompressible. A text is
also rejected when more than ``CHUNK_SHARE`` of its bytes lie in chunks outside
the limits of their length, so a repetitive stretch is not averaged away.

Defined cases: NULL and empty texts have no words and fail the base rules;
repeated rows get equal rows; NULL ids are kept; an empty table gives no rows;
other columns are ignored. Texts are handled whole and one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import WORD, slices, table

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
LEVEL = 3
CHUNK = 2048  # bytes
CHUNK_SHARE = 0.2
#: Limits at text lengths in bytes; between them the limit follows the logarithm of the length.
BYTES = (64, 128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 262144, 1048576)
UPPER = (1.35, 1.50, 1.72, 1.92, 2.09, 2.20, 2.32, 2.40, 2.48, 2.56, 2.66, 2.90, 3.20)
LOWER = (0.80, 0.90, 1.15, 1.28, 1.36, 1.42, 1.45, 1.45, 1.45, 1.45, 1.45, 1.45, 1.45)

words_of = re.compile(WORD).findall


def limits(n: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) ratio for texts of ``n`` bytes."""
    x, knots = np.log2(np.maximum(n, 1)), np.log2(BYTES)
    return np.interp(x, knots, LOWER), np.interp(x, knots, UPPER)


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, first occurrence included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    code = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    key, top = code[:n], len(seen)
    for i in range(1, width):
        if top * len(seen) >= 1 << 62:
            kinds, key = np.unique(key, return_inverse=True)
            top = len(kinds)
        key, top = key * len(seen) + code[i : i + n], top * len(seen)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    step = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.isin(key, twice))
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated_words(words))


def ratios(data: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its bytes in chunks outside the limits."""
    if not data:
        return 0.0, 0.0
    ratio = len(data) / len(packer.compress(data))
    if len(data) <= CHUNK:
        return ratio, 0.0
    sizes = np.array([[len(c), len(packer.compress(c))] for c in (data[i : i + CHUNK] for i in range(0, len(data), CHUNK))])
    low, high = limits(sizes[:, 0])
    each = sizes[:, 0] / sizes[:, 1]
    return ratio, float(sizes[(each < low) | (each > high), 0].sum() / len(data))


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, ratio double, bad_chunk_share double")


def verdicts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, kept, ratio and bad_chunk_share of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {COLUMNS}"
    names = ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for b in slices(batches):
            counts, packed, size = [], [], []
            for t in b.column("text").to_pylist():
                data = t.encode() if t else b""
                counts.append(base_counts(t))
                packed.append(ratios(data, packer))
                size.append(len(data))
            c = np.array(counts, np.int64).reshape(-1, 5)
            r = np.array(packed, np.float64).reshape(-1, 2)
            low, high = limits(np.array(size, np.int64))
            failed = (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEAT_PERCENT * c[:, 0])
            kept = ~failed & (r[:, 0] >= low) & (r[:, 0] <= high) & (r[:, 1] <= CHUNK_SHARE)
            cols = [b.column("doc_id"), *(pa.array(c[:, i].copy()) for i in range(5)), pa.array(failed), pa.array(kept),
                    pa.array(r[:, 0].copy()), pa.array(r[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for b in slices(batches, text_col):
            yield b.filter(pa.array([passes(t, packer) for t in b.column(text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)


def passes(text: str | None, packer: zstandard.ZstdCompressor) -> bool:
    """The verdict on one text."""
    n_words, _, _, _, n_repeat = base_counts(text)
    if n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words:
        return False
    data = text.encode()
    ratio, bad = ratios(data, packer)
    low, high = limits(len(data))
    return bool(low <= ratio <= high and bad <= CHUNK_SHARE)


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))
