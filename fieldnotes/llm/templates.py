"""Benchmark decontamination by template windows and slot consistency.

A text becomes a template: words are lower-cased without the punctuation around
them; numbers, units of measure and names are replaced by typed placeholders
and kept aside as slot values. A name is a run of capitalised words; a unit is a
known unit word after a number. A capitalised word that starts a sentence is a name
if it stands capitalised inside a sentence of the same text; else it is in doubt, and
the text has two readings: in one such words are literals, in the other they are
names. Items and documents are compared reading by reading. Line feeds are spaces
like others, so wrapping a text anew changes nothing.

Windows of ``WINDOW`` template tokens (of all tokens, if an item has fewer) are
hashed and joined, so a question whose numbers, names or units were changed still
matches. Windows with fewer than ``LITERALS`` literal tokens say too little and
count only for items without others. A document's windows pass a Bloom filter of
fixed size built from the benchmark before they are shuffled; the hash join that
follows is exact, whatever the size of the benchmark.

A window that many items and many documents hold would join all with all. A document
that is contaminated by an item has ``COVERAGE`` of its windows, so at least one of
its rarest ones: of the m windows of an item that occur at all and the c that are needed,
the m - c + 1 that occur least name the pairs that are compared. Nothing is lost.

Matches on one diagonal (position in the document minus position in the item)
are one alignment. In it, a changed question maps each slot value of the item to
one value of the document and back; an alignment in which more than
``CONFLICTS`` of the value pairs break that is dropped. A document is
contaminated by an item if in one reading its alignments cover ``COVERAGE`` of the
item's windows.

Defined cases: NULL and empty texts and items without ``MIN_TOKENS`` tokens match
nothing; NULL ids are kept; repeated rows and copies get the same verdict; an
empty table of documents gives no rows, an empty benchmark a clean bill for all;
other columns are ignored (``drop_contaminated`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldnotes.llm.util import KeyFilter, Shared, cut, fresh, key_filter, slices, table

WINDOW = 8
LITERALS = 4
MIN_TOKENS = 4
COVERAGE = 0.5
CONFLICTS = 0.2
#: Unit words (fixed values).
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mile miles meter meters metre metres kilometer
 kilometers kilometre kilometres g kg mg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons tonne
 tonnes l ml liter liters litre litres gallon gallons pint pints cup cups s sec second seconds min minute minutes h hr
 hour hours day days week weeks month months year years dollar dollars cent cents euro euros usd eur gbp percent
 degree degrees mph kmh watt watts kw kwh volt volts joule joules byte bytes kb mb gb tb""".split())
LITERAL, NUMBER, UNIT, NAME = range(4)
PARTS = re.compile(r"[$€£]?[0-9]+(?:[.,:/][0-9]+)*%?|[^\W\d_]+(?:['’-][^\W\d_]+)*")
SLOT_CODES = np.array([0, *(xxhash.xxh3_64_intdigest(x) for x in (b"number", b"unit", b"name"))], np.uint64)
END_MARKS = (".", "!", "?")
CLOSING = "\"')]»”’"
CACHED = 400_000  # words whose tokens are remembered
WORDS_KNOWN = 1 << 18  # words of a benchmark up to which they are told to the tasks, which then skip all others


def kind_of(part: str) -> int:
    """Kind of a number or a run of letters."""
    if not part[0].isalpha():
        return NUMBER
    if part.lower() in UNITS:
        return UNIT
    return NAME if part[0].isupper() and part[1:].islower() else LITERAL


def hashed(part: str) -> int:
    return xxhash.xxh3_64_intdigest(part.lower())


def word_tokens(word: str) -> list[tuple[int, int]]:
    """(kind, hash of the value) of the tokens in a word; names at sentence starts are still in doubt."""
    core = word.rstrip(".,;:!?")
    if core.isalpha():  # one run of letters, as most words are
        return [(kind_of(core), hashed(core))]
    return [(kind_of(part), hashed(part)) for part in PARTS.findall(word)]


def is_plain(core: bytes) -> bool:
    """One run of lower-case letters."""
    if core.isascii():
        return core.isalpha() and core.islower()
    text = core.decode()
    return text.isalpha() and text.islower()


class Tokens(dict):
    """Template tokens of texts. Maps a word to its number; a new word is taken apart, recent ones are remembered."""

    def __init__(self, known: frozenset[bytes] | None = None) -> None:
        """``known``: the only lower-case words whose identity matters; all others are one literal that matches nothing."""
        super().__init__()
        self.known = known
        self.empty()

    def empty(self) -> None:
        self.clear()
        # numbers 0 and 1: an unknown word, and one that ends a sentence
        self.kinds: list[int] = [LITERAL, LITERAL]
        self.values: list[int] = [0, 0]
        self.starts: list[int] = [0, 1, 2]
        self.ends: list[bool] = [False, True]

    def __missing__(self, word: bytes) -> int:
        if self.known is not None:
            core = word.rstrip(b".,;:!?")
            if core not in self.known and is_plain(core):
                i = self[word] = int(word[-1:] in (b".", b"!", b"?"))
                return i
        i = self[word] = len(self.ends)
        text = word.decode()
        for kind, value in word_tokens(text):
            self.kinds.append(kind)
            self.values.append(value)
        self.starts.append(len(self.kinds))
        self.ends.append(text[-1] in END_MARKS or (text[-1] in CLOSING and text.rstrip(CLOSING)[-1:] in END_MARKS))
        return i

    def of(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, kind, value) per template token of all ``texts``, in order: with words in doubt as literals, and with them as names."""
        if len(self) > CACHED:
            self.empty()
        each = [np.empty(0, np.int32)]
        for t in texts:
            words = t.encode().split()
            each.append(np.fromiter(map(self.__getitem__, words), np.int32, len(words)))
        ids = np.concatenate(each)
        starts, ends = np.array(self.starts, np.int32), np.array(self.ends, bool)
        first = starts[ids]
        n = starts[ids + 1] - first
        word = np.repeat(np.arange(len(ids), dtype=np.int32), n)
        rank = np.arange(len(word), dtype=np.int32) - np.repeat((np.cumsum(n) - n).astype(np.int32), n)
        at = first[word] + rank
        kind, value = np.array(self.kinds, np.int8)[at], np.array(self.values, np.uint64)[at]
        text_of = np.repeat(np.arange(len(texts), dtype=np.int32), [len(e) for e in each[1:]])
        closed = np.concatenate([[True], ends[ids[:-1]] | (text_of[1:] != text_of[:-1])])[: len(ids)]  # words that start a sentence
        text = text_of[word]
        # a unit word counts after a number only
        kind[(kind == UNIT) & (before(text, kind) != NUMBER)] = LITERAL
        name = kind == NAME
        doubt = name & closed[word] & (rank == 0)
        held = value ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        doubt &= ~np.isin(held, held[name & ~doubt])
        literal = kind.copy()
        literal[doubt] = LITERAL
        return [in_runs(text, literal, value), in_runs(text, kind, value)]


def before(text: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Kind of the token before each one in its text, or -1."""
    out = np.full(len(kind), -1, kind.dtype)
    out[1:] = np.where(text[1:] == text[:-1], kind[:-1], -1)
    return out


def in_runs(text: np.ndarray, kind: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens with each run of capitalised words as one name."""
    more = (kind == NAME) & (before(text, kind) == NAME)
    if not more.any():
        return text, kind, value
    keep = np.flatnonzero(~more)
    return text[keep], kind[keep], np.add.reduceat(value, keep)


def window_hashes(text: np.ndarray, kind: np.ndarray, value: np.ndarray, width: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each window of ``width`` tokens of one text in a reading: literals by value, slots by kind."""
    n = len(kind) - width + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    code = np.where(kind == LITERAL, value, SLOT_CODES[kind])
    # by doubling: the hash of a window from those of its halves
    h, done, factor = code, 1, np.full(1, 0x9E3779B97F4A7C15, np.uint64)
    while 2 * done <= width:
        h, done, factor = h[:-done] * factor + h[done:], 2 * done, factor * factor
    rest = width - done
    if rest:
        tail = np.zeros(n, np.uint64)
        for j in range(done, width):
            tail = tail * np.uint64(0x9E3779B97F4A7C15) + code[j : j + n]
        h = h[:n] * np.uint64(0xBF58476D1CE4E5B9) + tail
    h = (h + np.uint64(width + (reading << 32))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    start = np.flatnonzero(text[:n] == text[width - 1 :])
    return start, h[start]


def slots(kind: np.ndarray, value: np.ndarray, i: int, width: int) -> tuple[list[int], list[int]]:
    """Offsets and values of the slots in a window."""
    at = np.flatnonzero(kind[i : i + width] != LITERAL)
    return at.tolist(), value[i : i + width][at].view(np.int64).tolist()


MATCHES = "reading int, w long, at int, slot_at array<int>, slot_value array<long>"


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, width, n_windows, reading, w, at, slot_at, slot_value) of the windows of every item (item_id, text)."""
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, width int, n_windows int, {MATCHES}"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for b in slices(batches):
            rows = []
            for i, item in enumerate(b.column("text").to_pylist()):
                for reading, (text, kind, value) in enumerate(tokens.of([item or ""])):
                    if len(kind) < MIN_TOKENS:
                        continue
                    width = min(WINDOW, len(kind))
                    _, hashes = window_hashes(text, kind, value, width, reading)
                    literal = np.convolve(kind == LITERAL, np.ones(width, np.int64), "valid")
                    use = np.flatnonzero(literal >= min(LITERALS, width))
                    use = use if len(use) else np.arange(len(hashes))
                    rows += [(i, width, len(use), reading, int(hashes[j].astype(np.int64)), int(j), *slots(kind, value, j, width)) for j in use]
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            ids = b.column("item_id").take(pa.array(list(cols[0]), pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(list(c), t) for c, t in zip(cols[1:], kinds))], names)

    return items.mapInArrow(run, schema)


def vocabulary(items: DataFrame) -> frozenset[bytes] | None:
    """Lower-cased words of all items and units, or None if there are more than ``WORDS_KNOWN``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = {part.lower() for t in b.column("text").to_pylist() for part in PARTS.findall(t or "")}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["word"])

    words = items.select("text").mapInArrow(run, "word string").distinct().limit(WORDS_KNOWN + 1).toArrow().column("word").to_pylist()
    return frozenset(w.encode() for w in UNITS.union(words)) if len(words) <= WORDS_KNOWN else None


def text_windows(texts: DataFrame, keys: KeyFilter, widths: list[int], known: frozenset[bytes] | None) -> DataFrame:
    """(k, reading, w, at, slot_at, slot_value) of the windows of (k, text) that the benchmark may hold."""
    shared = Shared(texts.sparkSession, (keys, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known = shared.value
        tokens = Tokens(known)
        for b in slices(batches):
            rows = []
            k = b.column("k").to_numpy()
            for reading, (text, kind, value) in enumerate(tokens.of(b.column("text").to_pylist())):
                first = np.searchsorted(text, np.arange(len(k)))
                for width in widths:
                    start, hashes = window_hashes(text, kind, value, width, reading)
                    hit = np.flatnonzero(keys.may_hold(hashes))
                    rows += [(int(k[text[i]]), reading, int(h), int(i - first[text[i]]), *slots(kind, value, i, width))
                             for i, h in zip(start[hit].tolist(), hashes[hit].view(np.int64).tolist())]
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["k", "reading", "w", "at", "slot_at", "slot_value"])

    return texts.select("k", "text").mapInArrow(run, f"k long, {MATCHES}")


def candidates(found: DataFrame, known: DataFrame) -> DataFrame:
    """(k, item, reading) of the texts that hold one of the rarest windows of an item, of as many as must leave one for ``COVERAGE``."""
    often = found.groupBy("w").agg(F.count("*").alias("often"))
    held = known.select("item", "reading", "n_windows", "item_at", "w").join(often, "w")
    same = Window.partitionBy("item", "reading", "n_windows")
    ranked = held.select("*", F.row_number().over(same.orderBy("often", "item_at")).alias("rank"), F.count("*").over(same).alias("m"))
    rare = ranked.where(F.col("rank") <= F.col("m") - F.ceil(F.lit(COVERAGE) * F.col("n_windows")) + 1).select("w", "item", "reading").distinct()
    return found.select("k", "w").join(rare, "w").select("k", "item", "reading").distinct()


def matches(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(k, item_id, coverage) of the texts (k, text) and the items (item_id, text) that contaminate them."""
    known = item_windows(items).select("*", F.xxhash64("item_id").alias("item")).withColumnsRenamed({"at": "item_at", "slot_value": "item_value"})
    known = cut(known.drop("slot_at"), "template-items")
    widths = [r["width"] for r in known.select("width").distinct().collect()]  # at most WINDOW of them
    found = text_windows(texts, key_filter(known.select("w").distinct()), sorted(widths), vocabulary(items))
    found = cut(found, "template-windows")  # the texts are scanned once
    both = found.join(candidates(found, known), ["k", "reading"]).join(known, ["w", "item", "reading"]).withColumn("diagonal", F.col("at") - F.col("item_at"))
    line = ["k", "item_id", "reading", "n_windows", "diagonal"]
    pair = F.explode_outer(F.arrays_zip("slot_at", "item_value", "slot_value")).alias("s")
    slot = both.select(*line, "item_at", pair)
    # each place of an alignment once, then each pair of values
    pairs = slot.select(*line, F.col("s.item_value").alias("x"), F.col("s.slot_value").alias("y")).distinct()
    sound = pairs.groupBy(*line).agg(F.count("x").alias("pairs"), F.count_distinct("x").alias("xs"), F.count_distinct("y").alias("ys"))
    sound = sound.where(2 * F.col("pairs") - F.col("xs") - F.col("ys") <= CONFLICTS * F.col("pairs")).select(*[F.col(c).alias(f"s_{c}") for c in line])
    same = (F.col("k") == F.col("s_k")) & (F.col("reading") == F.col("s_reading")) & F.col("item_id").eqNullSafe(F.col("s_item_id")) & (F.col("diagonal") == F.col("s_diagonal")) & (F.col("n_windows") == F.col("s_n_windows"))
    covered = slot.select(*line, "item_at").distinct().join(sound, same, "left_semi").select("k", "item_id", "reading", "n_windows", "item_at").distinct()
    covered = covered.groupBy("k", "item_id", "reading", "n_windows").agg((F.count("*") / F.col("n_windows")).alias("coverage"))
    return covered.where(F.col("coverage") >= COVERAGE).groupBy("k", "item_id").agg(F.max("coverage").alias("coverage"))


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.select(F.xxhash64(F.col(text_col).cast("string")).alias("k"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")


def benchmark(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    return items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))


def contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(k, items, coverage): texts that hold benchmark items, ``k`` being the XXH64 of the text."""
    found = matches(keyed(docs, text_col), benchmark(items))
    return found.groupBy("k").agg(F.array_sort(F.collect_list("item_id")).alias("items"), F.max("coverage").alias("coverage"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, with all columns."""
    bad = fresh("bad", docs)
    found = contaminated(docs, items, text_col=text_col).select(F.col("k").alias(bad))
    return docs.join(found, F.xxhash64(F.col(text_col).cast("string")) == F.col(bad), "left_anti")


def op5_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    all_ = docs.select("doc_id", F.xxhash64("text").alias("h")).join(found, F.col("h") == F.col("k"), "left")
    return all_.select("doc_id", F.col("k").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
                       F.coalesce("coverage", F.lit(0.0)).alias("coverage"))
