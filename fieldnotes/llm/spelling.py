"""Spelling variants: words of a vocabulary that are one edit apart, by dynamic programming over sorted lists.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. A word's form is its near word of largest count, if that is ``RATIO`` times the
word's or more; its root is the last word that forms lead to.

1. Blocks: let a be the length of the shorter of two near words. Before and behind the
   place where they first differ all code points are equal, so with that place in a
   window [i, j) of the shorter word they share the first i and the last a - j code
   points. Each word goes to the blocks of the two halves of its length, once as the
   shorter and once as the longer word. A block too large for its words' bytes is cut
   at the middle of its window, again and again; a window of one code point leaves two
   code points free, so what cannot be cut is bounded by the alphabet's square.
   A pair counts only in the one block whose window has its place.
2. Scan: a block's words are sorted from the shared end, and each is compared with all
   others at once: row d of the edit matrix of every other word against the first d code
   points, a band of three diagonals. Rows up to the longest common prefix with the
   word before are taken over. Words whose row is above one edit are left out of all
   later rows, and so for the whole range of words with that prefix.
3. Each block gives the number of near words and the best one for each of its words;
   these are summed by word. No pair is ever a row.
4. Roots by pointer doubling. Counts grow by ``RATIO`` with each form, so chains are
   short and have no cycles.

Defined cases: NULL and empty words are left out; rows of one word are added up; of
near words with equal counts the first in code-point order is the form; an empty table
gives no rows; other columns are ignored. No list of words is ever held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import cut, table

LETTERS = "[A-Za-zÀ-ÿ]"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
BLOCK = 1 << 20  # code points of a block that is scanned as it is
BLOCK_COLUMNS = ("a", "i", "j", "shared")


def windows(words: DataFrame, spans: str) -> DataFrame:
    """The rows of ``words`` (word, n, further columns that ``spans`` names) for each of their windows (a, i, j), with what they share."""
    rows = words.select("word", "n", F.explode(F.expr(spans)).alias("s")).select("word", "n", "s.*")
    return rows.withColumn("shared", F.expr("concat(substr(word, 1, i), substr(word, length(word) - (a - j) + 1, a - j))"))


HALVES = """flatten(transform(filter(array(length(word), length(word) - 1), a -> a >= {least}), a -> if(a < 2,
    array(named_struct('a', a, 'i', 0, 'j', a)),
    array(named_struct('a', a, 'i', int(a div 2), 'j', a), named_struct('a', a, 'i', 0, 'j', int(a div 2))))))"""
SMALLER = "array(named_struct('a', a, 'i', int((i + j) div 2), 'j', j), named_struct('a', a, 'i', i, 'j', int((i + j) div 2)))"


def blocks(words: DataFrame, least: int, most: int) -> DataFrame:
    """(a, i, j, shared, word, n): every word in its blocks; none that can be cut has more than ``most`` code points."""
    rows, done = cut(windows(words, HALVES.format(least=least)), "spelling-blocks"), None
    while True:
        large = rows.groupBy(*BLOCK_COLUMNS).agg(F.count("*").alias("many")).where(f"many > 2 AND j - i > 1 AND many * (a + 1) > {most}").drop("many")
        large = cut(large, "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, list(BLOCK_COLUMNS), "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = cut(windows(rows.join(large, list(BLOCK_COLUMNS)), SMALLER), "spelling-blocks")


def codes(words: list[str], width: int) -> np.ndarray:
    """Code points of each word, one column further on; 0 before and behind."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), width), np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    out[row, 1 + np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def scan(words: list[str], known: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each word's place with those of all words one edit from it. ``words`` are different, sorted, alike in their first ``known``
    code points, and of lengths that differ by one at most."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    q = codes(words, int(size.max()) + 3)
    same = np.ones((len(words), 3), np.int8)  # of columns d - 1, d, d + 1 in row d
    same[:, 1] = 0
    rows = [(np.arange(len(words)), same)]  # from row ``known`` on
    lcp = np.zeros(len(words), np.int64)
    lcp[1:] = np.argmin(np.pad(q[1:, 1:] == q[:-1, 1:], ((0, 0), (0, 1))), 1)
    for v in range(len(words)):
        del rows[max(lcp[v] - known, 0) + 1 :]
        left, row = rows[-1]
        for d in range(known + len(rows) - 1, size[v]):
            other = row + (q[left, d : d + 3] != q[v, d + 1])
            new = np.empty_like(other)
            new[:, 0] = np.minimum(other[:, 0], row[:, 1] + 1)
            new[:, 1] = np.minimum(np.minimum(other[:, 1], row[:, 2] + 1), new[:, 0] + 1)
            new[:, 2] = np.minimum(other[:, 2], new[:, 1] + 1)
            keep = new.min(1) <= 1
            left, row = left[keep], new[keep]
            rows.append((left, row))
            if len(left) == 1:
                break  # the word itself
        else:
            apart = size[left] - size[v]
            near = left[row[np.arange(len(left)), apart + 1] == 1]
            if len(near):
                yield v, near


def near_in(block: tuple[int, int, int, str], words: list[str], counts: list[int]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, count and text of the best of them) of the words of a block; pairs that belong to another block are left out."""
    a, i, j, _ = block
    size = np.fromiter(map(len, words), np.int64, len(words))
    if len(words) < 2 or size.min() > a:
        return
    order = words if i else [w[::-1] for w in words]
    q = codes(words, int(size.max()) + 2)[:, 1:]
    n = np.array(counts, np.int64)
    for v, near in scan(order, i if i else a - j):
        place = np.argmax(q[near] != q[v], 1)  # the first that differs
        ok = (np.minimum(size[near], size[v]) == a) & (place >= i) & ((place < j) | (j == a))
        if ok.any():
            near = near[ok]
            top = n[near].max()
            yield words[v], len(near), int(top), min(words[k] for k in near[n[near] == top])


def near_words(words: DataFrame, least: int = 1, most: int = BLOCK) -> DataFrame:
    """(word, n_near, top_n, top): how many words of ``words`` (word, n) are near each one that has any, and the best of them.

    The words must be different and none shorter than ``least``.
    """
    rows = blocks(words, least, most)
    order = F.when(F.col("i") > 0, F.col("word")).otherwise(F.reverse("word"))
    rows = rows.select(*BLOCK_COLUMNS, "word", "n", order.alias("o")).repartition(*BLOCK_COLUMNS).sortWithinPartitions(*BLOCK_COLUMNS, "o").drop("o")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        found = (x for block, group in groupby(each, key=lambda r: r[:4]) for x in near_in(block, *map(list, zip(*(r[4:] for r in group)))))
        while part := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*part)], ["word", "near", "top_n", "top"])

    found = rows.mapInArrow(run, "word string, near bigint, top_n bigint, top string")
    best = F.min(F.struct((-F.col("top_n")).alias("minus"), F.col("top").alias("top")))
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.minus")).alias("top_n"), F.col("best.top").alias("top"))


def last_of(links: DataFrame) -> DataFrame:
    """(word, root) of each link (word, form): where the links from it end."""
    links = cut(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("at"), F.col("root").alias("further"))
        jumped = links.join(on, F.col("root") == F.col("at"), "left")
        jumped = cut(jumped.select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("moved")), "spelling-links")
        links = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = RATIO, most: int = BLOCK, *, word_col: str = "word", count_col: str = "n", least: int = 1) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``least`` code points with its count."""
    words = words.select(F.col(word_col).cast("string").alias("word"), F.col(count_col).cast("long").alias("n")).where(F.length("word") >= max(least, 1))
    words = cut(words.groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    near = near_words(words, max(least, 1), most)
    both = words.join(near, "word", "left")
    is_form = F.col("top_n") >= ratio * F.col("n")
    both = cut(both.select("word", F.when(is_form, F.col("top")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(is_form, F.col("top_n")).alias("form_n")), "spelling-forms")
    roots = last_of(both.where("form IS NOT NULL").select("word", "form"))
    return both.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def letter_runs(docs: DataFrame, least: int = MIN_LENGTH, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run): every maximal run of at least ``least`` letters in the texts, A to Z in lower case."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("line"))  # bounds the arrays below
    runs = lines.select("doc_id", F.explode(F.regexp_extract_all("line", F.lit(f"({LETTERS}{{{least},}})"), F.lit(1))).alias("run"))
    return runs.withColumn("run", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def op11_sorted_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the frequent words of the documents, where one run in 199 loses a letter."""
    runs = letter_runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
    runs = runs.withColumn("h", h)
    word = F.when(F.col("h") % 199 == 0, F.expr("overlay(run PLACING '' FROM CAST(h % length(run) AS INT) + 1 FOR 1)")).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)
    return variants(words, least=MIN_LENGTH)
