"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts, per language, in how many documents each n-gram occurs (every
document, folded inside the tasks before the shuffle). A language *contains* an
n-gram if at least ``MIN_RATE`` of its documents do, and at least ``MIN_SHARE``
of the rate of the language where it is most common. So the number of contained
n-grams is bounded by the mean number of n-grams per document over ``MIN_RATE``,
however large the corpus, and one filter of a fixed number of rows holds all
languages: row = hash position, one bit column per language. ANDing an n-gram's
rows gives the bitmask of all languages that contain it, in one lookup each.

A text's n-grams are looked up once each, the bits are counted per language, and
each count is corrected for the language's own false positive rate (share of set
bits to the power of the number of hashes). The largest corrected count
decides; the score is its share of the sum over languages.

Defined cases: a text that is NULL or has no letter gives ``und`` with score 0,
as does any text when nothing could be learned; a text without a known n-gram
gets the language with the most training documents, score 0; ties go to the
language name that comes first; rows with NULL text or language teach nothing;
repeated rows count as often as they occur; an empty table gives no rows; other
columns are ignored. Long texts are read whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import Shared, cut, id_hash, slices, table

SIZES = (2, 3, 4)
MIN_RATE = 0.002
MIN_SHARE = 0.05
HASHES = 4
ROWS_PER_GRAM = 8
PIECE = 1 << 20  # characters of a text worked on at once
FOLD = 1 << 21  # n-grams a task holds before it hands them on
UND = "und"


@cache
def letters() -> np.ndarray:
    """Per code point, 1 if it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the one of splitmix64), so that all bits of the hash depend on all of the n-gram."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def grams(text: str | None) -> np.ndarray:
    """Distinct n-gram hashes of the lower-cased letters; every run of other characters is one blank, as are both ends."""
    found = []
    over = max(SIZES) - 1
    for i in range(0, len(text or ""), PIECE):
        part = text[max(0, i - over) : i + PIECE].lower()
        c = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        c = np.where(letters()[c], c, 32).astype(np.uint64)
        if i == 0:
            c = np.concatenate([[np.uint64(32)], c])
        if i + PIECE >= len(text):
            c = np.concatenate([c, [np.uint64(32)]])
        c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
        if not (c != 32).any():
            continue
        h = c
        for n in range(2, max(SIZES) + 1):
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1 :]
            if n in SIZES:
                found.append(mixed(h + np.uint64(n)))
        found = [distinct(np.concatenate(found))]
    return found[0] if found else np.empty(0, np.uint64)


@dataclass
class Filter:
    """The learned filter: ``masks`` (rows, words) of 64-bit masks; ``rates`` the false positive rate per language."""

    langs: list[str]
    docs: list[int]
    masks: np.ndarray
    rates: np.ndarray

    def counts(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(texts, languages) counts of n-grams, ``hashes[bounds[i]:bounds[i + 1]]`` being those of text i."""
        rows = np.uint64(len(self.masks) - 1)
        at, step = hashes & rows, (hashes >> np.uint64(32)) | np.uint64(1)
        mask = self.masks[at]
        for i in range(1, HASHES):
            mask = mask & self.masks[(at + np.uint64(i) * step) & rows]
        out = np.zeros((len(bounds) - 1, len(self.langs)), np.int64)
        for j in range(len(self.langs)):
            bit = ((mask[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(bit)])
            out[:, j] = total[bounds[1:]] - total[bounds[:-1]]
        return out

    def decide(self, hashes: list[np.ndarray]) -> tuple[list[str], list[float]]:
        """Language and score per text; an empty array is a text without letters."""
        if not self.langs:
            return [UND] * len(hashes), [0.0] * len(hashes)
        sizes = np.array([len(h) for h in hashes], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        hits = self.counts(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), bounds)
        true = np.maximum(0.0, (hits - sizes[:, None] * self.rates) / (1 - np.minimum(self.rates, 0.999999)))
        best, total = true.argmax(axis=1), true.sum(axis=1)
        usual = int(np.argmax(self.docs))
        langs, scores = [], []
        for i, n in enumerate(sizes.tolist()):
            known = total[i] > 0
            langs.append(UND if not n else self.langs[best[i] if known else usual])
            scores.append(float(true[i, best[i]] / total[i]) if n and known else 0.0)
        return langs, scores


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): documents of each language that hold each n-gram, over all of ``docs`` (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # language, gram, n

        def folded() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            lang, gram, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((gram, lang))
            lang, gram, n = lang[order], gram[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (gram[1:] != gram[:-1])]))
            return lang[first], gram[first], np.add.reduceat(n, first)

        def rows(lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            words = pa.array(list(names), pa.string())
            for i in range(0, len(n), 1 << 18):
                s = slice(i, i + (1 << 18))
                yield pa.RecordBatch.from_arrays([words.take(pa.array(lang[s])), pa.array(gram[s].view(np.int64)), pa.array(n[s])], ["lang", "gram", "n"])

        waiting = 0
        for b in slices(batches):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                g = grams(text)
                held.append((np.full(len(g), names.setdefault(lang, len(names))), g, np.ones(len(g), np.int64)))
                waiting += len(g)
                if waiting > FOLD:
                    held = [folded()]
                    if len(held[0][0]) > FOLD // 2:
                        yield from rows(*held.pop())
                    waiting = 0
        if held:
            yield from rows(*folded())

    rows = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Filter:
    """The filter of all languages of ``docs``."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    size = {r["lang"]: r["n"] for r in rows.where("text IS NOT NULL AND lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(size)
    if not langs:
        return Filter([], [], np.zeros((1, 1), np.uint64), np.zeros(0))
    kinds = docs.sparkSession.createDataFrame([(x, i, size[x]) for i, x in enumerate(langs)], "lang string, i int, docs long")
    rate = F.col("n") / F.col("docs")
    kept = gram_counts(rows).join(kinds, "lang").where((rate >= MIN_RATE) & ((F.col("n") > 1) | (F.col("docs") < 1 / MIN_RATE)))
    # the languages of an n-gram side by side: at most one entry per language
    each = kept.groupBy("gram").agg(F.collect_list(F.struct("i", rate.alias("rate"))).alias("held"), F.max(rate).alias("top"))
    each = cut(each, "langid-grams")
    n_rows = 1 << max(10, (ROWS_PER_GRAM * each.count() - 1).bit_length())

    def word(w: int) -> Column:
        bit = lambda acc, x: F.when((x["i"].between(64 * w, 64 * w + 63)) & (x["rate"] >= MIN_SHARE * F.col("top")),
                                    acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["i"] % 64))).otherwise(acc)
        return F.aggregate("held", F.lit(0).cast("long"), bit)

    words = range((len(langs) + 63) // 64)
    at, step = F.col("gram").bitwiseAND(F.lit(n_rows - 1)), F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1))
    spots = F.array(*[(at + F.lit(i).cast("long") * step).bitwiseAND(F.lit(n_rows - 1)) for i in range(HASHES)])
    bits = each.select(F.explode(spots).alias("at"), *[word(w).alias(f"m{w}") for w in words])
    bits = bits.groupBy("at").agg(*[F.bit_or(f"m{w}").alias(f"m{w}") for w in words]).toArrow()  # at most n_rows rows
    masks = np.zeros((n_rows, len(words)), np.uint64)
    for w in words:
        masks[bits.column("at").to_numpy(), w] = bits.column(f"m{w}").to_numpy().astype(np.int64).view(np.uint64)
    fill = np.array([((masks[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).mean() for j in range(len(langs))])
    return Filter(langs, [size[x] for x in langs], masks, fill**HASHES)


def predict(docs: DataFrame, model: Filter, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = Shared(docs.sparkSession, model)  # a filter of bounded size, see above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            langs, scores = shared.value.decide([grams(t) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op3_bloom_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_hash(F.col("doc_id")) % 4 == 2
    found = predict(docs, learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
