"""LM scoring with a hierarchical Pitman-Yor model, sampled by Gibbs.

Tokens are words (ASCII letters lower-cased) and one end. The model spells them:
a word is its UTF-8 bytes and a space, the end one more symbol, so unknown words
have a probability too, and the probability of a text is the product over its
symbols. Each symbol is predicted from the ``CONTEXT`` symbols before it. Every
context is a restaurant of a Chinese restaurant process whose tables are
customers of the parent restaurant, the context without its farthest symbol;
the parent of the empty context is uniform over 256 symbols.

Counts come from all training texts: sequences of CONTEXT + 1 symbols are folded in the
tasks, sent in arrays by bucket and summed there. Every sequence has a dish, however rare,
so the model grows with the corpus and is a table. Contexts that end in the same two
symbols share all ancestors but those of at most one symbol, so all such contexts are
sampled in one task, given the prediction of each symbol by the one before it (at most
65536 numbers); between two rounds these top restaurants are seated with the tables the
tasks report. A sweep removes and seats all customers of a restaurant anew, deepest level
first, given the parent's predictions; customers of a dish come in batches of a tenth of
those seated. After ``BURN`` sweeps, ``SAMPLES`` seatings are kept and a symbol's
probability is the mean of theirs. Sequences to be scored that no training text holds are
dishes without a customer, which change no seating and get the restaurants' prediction.

A text's score is the sum over its sequences. The most frequent ones (at most
2**``FREQUENT``) are broadcast with their logarithms; the rest of a text's, packed in arrays by buckets of
the sequences, meet the table's bucket by bucket in a fixed number of tasks, each of which adds them up by text; its sums are packed again,
dealt by the arrays they come from and added. Logarithms are whole multiples of 1 / ``UNIT``, so sums do not depend on their order.

The base score needs the count of every word. Words that make up at least
2**-``HOT`` of all tokens (so at most 2**``HOT`` of them) are broadcast with their
counts; the rest of a text's words are joined with the counts by Spark. Words are
told apart by XXH64.

Defined cases: NULL and empty texts are one end token; NULL ids count as empty
text in the split; repeated rows are trained on and scored as often as they
occur; with no training text all symbols are alike and no token is known; an
empty table gives no rows; other columns are ignored. Reruns agree.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import Shared, cut, id_hash, slices, table

CONTEXT = 6
SYMBOLS = 256
END = b"\n"  # no byte of a word
SHARE = 21  # of ``dishes`` alone
HOT = 21  # words
FREQUENT = 20  # sequences
DISCOUNT = (0.5, 0.6, 0.7, 0.75, 0.8, 0.8, 0.8)  # by length of the context
STRENGTH = (10.0, 5.0, 2.0, 1.0, 1.0, 1.0, 1.0)
ROUNDS, BURN, SAMPLES = 2, 2, 3
BATCH = 0.1
SEED = 20
SLICE = 1 << 20  # bytes of text worked on at once
FOLD = 1 << 18  # distinct words, and sequences by the fourfold, a task holds before it hands their counts on
BUCKETS = 256  # that sequences are dealt to by the two symbols before the last
GROUP = 1 << 16  # sequences that are sampled together, about
JOINED = 64  # partitions in which texts meet the table; up to SUMS texts have at most one sum in each, so their number stays in proportion to the texts
SUMS = 1 << 24  # of texts that a task holds before it hands them on, packed by the arrays they come from
BATCH_BYTES = 16 << 20  # of arrays that a task gets at once
UNIT = 1 << 32
WORDS, GRAMS = 0, 1
END_WORD = xxhash.xxh64_intdigest(END)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def spelled(words: list[bytes]) -> bytes:
    """The symbols of a text behind the padding that stands for its start."""
    return END * CONTEXT + b" ".join([*words, END])


def grams(data: bytes) -> np.ndarray:
    """The sequence of CONTEXT + 1 symbols that ends at each place from CONTEXT on."""
    k, have = np.frombuffer(data, np.uint8).astype(np.uint64), 1
    while have <= CONTEXT:
        more = min(have, CONTEXT + 1 - have)
        k = (k[:-more] << np.uint64(8 * more)) | (k[more:] & np.uint64((1 << 8 * more) - 1))
        have += more
    return k


def places(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sequence that ends at each symbol of the spelled texts, one after another, and the number of symbols of each text."""
    size = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(size) - size
    inside = np.ones(size.sum(), bool)
    for j in range(CONTEXT):
        inside[begin + j] = False
    return grams(b"".join(parts))[inside[CONTEXT:]], size - CONTEXT


def bucket(key: np.ndarray) -> np.ndarray:
    """One for all sequences with the same two symbols before the last."""
    return (((key >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(40503) >> np.uint64(8)).astype(np.uint8)


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers by planes of equal bytes, compressed, behind their number."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 8 * n, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(kind).ravel()


def dealt(at: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """The numbers of the buckets ``at`` that occur, and for each of ``columns`` its packed numbers in each of these."""
    order = np.argsort(at, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(at, minlength=BUCKETS)))
    used = [i for i in range(BUCKETS) if ends[i] < ends[i + 1]]
    parts = ([packed(x[ends[i] : ends[i + 1]]) for i in used] for x in (c[order] for c in columns))
    return [pa.array(used, pa.int32()), *(pa.array(x, pa.binary()) for x in parts)]


def spread(key: np.ndarray) -> np.ndarray:
    """Evenly dealt bucket of each sequence."""
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def corpus_counts(docs: DataFrame, trained: Column | None = None) -> DataFrame:
    """(kind, key, n): counts of all words and ends, and of all symbol sequences, of the texts of ``docs`` (text).

    With ``trained`` only the rows for which it holds are counted; sequences of other rows alone have n = 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            used, *parts = dealt(bucket(key), key, n.astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(used), pa.int8()), used, *parts], ["kind", "bucket", "keys", "ns"])

        def counted_words() -> pa.RecordBatch:
            key = np.fromiter(map(xxhash.xxh64_intdigest, seen), np.uint64, len(seen))
            return rows(WORDS, key, np.fromiter(seen.values(), np.int64, len(seen)))

        for b in slices(batches, limit=SLICE):
            learnt, other = [], []
            for t, own in zip(b.column("text").to_pylist(), b.column("trained").to_pylist()):
                words = words_of(t)
                if own:
                    seen.update(words)
                    seen[END] += 1
                (learnt if own else other).append(spelled(words))
            if learnt:
                held.append(np.unique(places(learnt)[0], return_counts=True))
            if other:
                key = np.unique(places(other)[0])
                held.append((key, np.zeros(len(key), np.int64)))
            if len(held) > 8:
                held = [folded(held)]
                if len(held[0][0]) > 4 * FOLD:
                    yield rows(GRAMS, *held.pop())
            if len(seen) > FOLD:
                yield counted_words()
                seen.clear()
        if held:
            yield rows(GRAMS, *folded(held))
        if seen:
            yield counted_words()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}  # the sum so far, and parts of at most its size
        for b in batches:
            for kind, at, keys, ns in zip(*(c.to_pylist() for c in b.columns)):
                parts = held.setdefault((kind, at), [])
                parts.append((unpacked(keys, np.uint64), unpacked(ns, np.int64)))
                if len(parts) > 4 and sum(len(k) for k, _ in parts[1:]) > len(parts[0][0]):
                    parts[:] = [folded(parts)]
        for (kind, _), parts in held.items():
            key, n = folded(parts)
            parts.clear()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int8)), signed(key), pa.array(n)], ["kind", "key", "n"])

    rows = docs.select("text", (F.lit(True) if trained is None else trained).alias("trained"))
    parts = rows.mapInArrow(run, "kind byte, bucket int, keys binary, ns binary").repartition("kind", "bucket")
    return cut_arrays(parts.mapInArrow(summed, "kind byte, key long, n long"), "lm-counts")


def cut_arrays(df: DataFrame, name: str) -> DataFrame:
    """``cut`` for tasks in Python that get rows of packed arrays, which are large."""
    conf, most = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(most)
    conf.set(most, str(BATCH_BYTES))
    try:
        return cut(df, name)
    finally:
        conf.set(most, before)


def folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def dishes(grams_: DataFrame, total: int) -> DataFrame:
    """Which sequences make up 2**-``SHARE`` of all places, for a look at the counts; the model has a dish for every one.

    (level, key, direct, passed): these sequences, with the customers that come by no longer context; and with NULL ``direct`` the contexts, with the customers they pass on for want of a dish."""
    least = max(1, total >> SHARE)
    level, kept = grams_.select("key", "n", F.col("n").alias("direct")), []
    for length in range(CONTEXT, -1, -1):
        if length < 2:  # at most 65536 and 256 sequences
            has = F.lit(True)
        else:
            has = F.col("n") >= least
        none = F.lit(None).cast("long")
        kept.append(level.where(has).select(F.lit(length).alias("level"), "key", "direct", none.alias("passed")))
        if length > 1:
            rare = level.groupBy(F.shiftright("key", 8).alias("key")).agg(F.sum(F.when(~has, F.col("n"))).alias("passed"), F.max(has).alias("served"))
            kept.append(rare.where("served AND passed > 0").select(F.lit(length).alias("level"), "key", none.alias("direct"), "passed"))
        if length:
            shorter = F.col("key").bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("key")
            level = level.groupBy(shorter).agg(F.sum("n").alias("n"), F.sum(F.when(has, 0).otherwise(F.col("n"))).alias("direct"))
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return cut(out, "lm-dishes")


def seat(customers: np.ndarray, base: np.ndarray, room: np.ndarray, d: float, strength: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after all ``customers`` have sat down; ``room`` is the dish's restaurant, ``base`` its probability
    there, ``strength`` that of each restaurant."""
    seated = (customers > 0).astype(np.int64)  # the first customer of each opens a table
    tables = seated.copy()
    in_room = np.bincount(room, tables, len(strength))
    left = np.flatnonzero(customers > 1)
    while len(left):
        n = np.minimum(customers[left] - seated[left], np.maximum(1, (BATCH * seated[left]).astype(np.int64)))
        at = room[left]
        new = (strength[at] + d * in_room[at]) * base[left]
        old = seated[left] - d * tables[left]
        p = new / np.maximum(new + old, 1e-300)
        opened = (rng.random(len(left)) < p).astype(np.int64)
        more = np.flatnonzero(n > 1)
        opened[more] = rng.binomial(n[more], p[more])
        tables[left] += opened
        some = np.flatnonzero(opened)
        np.add.at(in_room, at[some], opened[some].astype(np.float64))
        seated[left] += n
        left = left[seated[left] < customers[left]]
    return tables


def symbols(n: int) -> np.uint64:
    """Mask of the last ``n`` symbols of a sequence."""
    return np.uint64((1 << 8 * n) - 1)


class Forest:
    """The restaurants of contexts of two symbols and more, by length, of sorted sequences ``key`` with ``n`` customers each.

    All sequences of a context's last two symbols belong together; ``above`` is the probability of every symbol after every one.
    """

    def __init__(self, key: np.ndarray, n: np.ndarray, above: np.ndarray) -> None:
        self.keys, self.parent, self.rooms, self.strength, self.direct = {CONTEXT: key}, {}, {}, {}, n
        for m in range(CONTEXT - 1, 1, -1):
            self.keys[m], self.parent[m + 1] = np.unique(self.keys[m + 1] & symbols(m + 1), return_inverse=True)
        self.parent[2] = (self.keys[2] & symbols(2)).astype(np.int64)
        for m, k in self.keys.items():
            context = k >> np.uint64(8)
            self.rooms[m] = np.cumsum(np.append(False, context[1:] != context[:-1])[: len(k)])
            self.strength[m] = np.full(self.rooms[m][-1] + 1 if len(k) else 0, STRENGTH[m])
        self.tables = {CONTEXT: (n > 0).astype(np.int64)}
        for m in range(CONTEXT - 1, 1, -1):
            self.tables[m] = (self.customers(m) > 0).astype(np.int64)
        self.predict_all(above)

    def customers(self, m: int) -> np.ndarray:
        if m == CONTEXT:
            return self.direct
        return np.bincount(self.parent[m + 1], self.tables[m + 1], len(self.keys[m])).astype(np.int64)

    def predict_all(self, above: np.ndarray) -> None:
        """Probability of every dish in its restaurant."""
        self.probability = {1: above}
        for m in range(2, CONTEXT + 1):
            self.probability[m] = predicted(self.customers(m), self.tables[m], self.rooms[m], DISCOUNT[m], self.strength[m], self.probability[m - 1][self.parent[m]])

    def sweep(self, above: np.ndarray, rng: np.random.Generator) -> None:
        for m in range(CONTEXT, 1, -1):
            base = self.probability[m - 1][self.parent[m]]
            self.tables[m] = seat(self.customers(m), base, self.rooms[m], DISCOUNT[m], self.strength[m], rng)
        self.predict_all(above)


def predicted(customers: np.ndarray, tables: np.ndarray, room: np.ndarray, d: float, strength: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Probability of dishes by their customers and tables, and their probability ``above``."""
    n = len(strength)
    of_room, in_room = np.bincount(room, customers, n), np.bincount(room, tables, n)
    share = (strength + d * in_room) / (strength + of_room)
    return np.maximum(customers - d * tables, 0) / (strength + of_room)[room] + share[room] * above


def seated_top(customers: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probability of every symbol after every one, by the ``customers`` of these 65536 dishes."""
    pair = np.arange(SYMBOLS * SYMBOLS)
    room, symbol, uniform = pair // SYMBOLS, pair % SYMBOLS, np.full(SYMBOLS, 1 / SYMBOLS)
    strength, one, top = np.full(SYMBOLS, STRENGTH[1]), np.zeros(SYMBOLS, np.int64), np.full(1, STRENGTH[0])
    tables = (customers > 0).astype(np.int64)
    for _ in range(BURN):
        below = np.bincount(symbol, tables, SYMBOLS).astype(np.int64)
        root = predicted(below, seat(below, uniform, one, DISCOUNT[0], top, rng), one, DISCOUNT[0], top, uniform)
        tables = seat(customers, root[symbol], room, DISCOUNT[1], strength, rng)
    return predicted(customers, tables, room, DISCOUNT[1], strength, root[symbol])


def sampled(sequences: DataFrame, groups: int, above: np.ndarray, sweeps: int, keep: int) -> DataFrame:
    """Gibbs sampling of the restaurants of all ``sequences`` (key, n): (key, n, log), log10 of the mean probability of the
    ``keep`` last sweeps times UNIT; without ``keep`` (key, n, 0), the tables of each pair of symbols."""
    shared = Shared(sequences.sparkSession, above)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        held.clear()
        keys, ns, above = t.column("key").to_numpy().view(np.uint64), t.column("n").to_numpy(), shared.value
        group = bucket(keys) & np.uint8(groups - 1)  # as ``%``, but 256 is no uint8
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            own = own[np.argsort(keys[own])]
            rng = np.random.default_rng([SEED, int(g)])
            forest = Forest(keys[own], ns[own], above)
            p = np.zeros(len(own))
            for i in range(sweeps):
                forest.sweep(above, rng)
                if i >= sweeps - keep:
                    p += forest.probability[CONTEXT]
            if keep:
                out = keys[own], ns[own], np.rint(np.log10(p / keep) * UNIT).astype(np.int64)
            else:
                n = np.bincount(forest.parent[2], forest.tables[2], SYMBOLS * SYMBOLS).astype(np.int64)
                out = np.flatnonzero(n).astype(np.uint64), n[n > 0], np.zeros(np.count_nonzero(n), np.int64)
            yield pa.RecordBatch.from_arrays([signed(out[0]), pa.array(out[1]), pa.array(out[2])], ["key", "n", "log"])

    # as ``bucket``
    group = F.shiftright(F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)) * 40503, 8).bitwiseAND(F.lit(groups - 1)).alias("g")
    return sequences.select("key", "n", group).repartition("g").select("key", "n").mapInArrow(run, "key long, n long, log long")


class Lookup:
    """Index of 64-bit keys by open addressing, for whole arrays at once."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self.start(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several that want a slot one gets it
            out = self.slots[at] != left
            left, at = left[out], (at[out] + 1) & (len(self.slots) - 1)

    def start(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self.start(keys)
        out = self.slots[at]
        left = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slots) - 1)
            out[left] = self.slots[at]
            wrong = (out[left] >= 0) & (self.keys[out[left]] != keys[left])
            left, at = left[wrong], at[wrong]
        return out


def longer(sums: dict[int, np.ndarray], at: int, n: int) -> np.ndarray:
    """The numbers ``at`` of ``sums``, with zeros behind them if they are less than ``n``."""
    have = sums.get(at)
    if have is None or len(have) < n:
        sums[at] = np.zeros(n, np.int64)
        if have is not None:
            sums[at][: len(have)] = have
    return sums[at]


def summed_logs(entries: DataFrame, values: DataFrame) -> DataFrame:
    """(row, score_cold): the sums by row of times * log of the ``entries`` (row, g, keys, texts, times), packed by ``spread``, over the sequences ``values`` (key, log).

    A row of ``entries`` holds numbers of texts that count from its ``row``. Of a bucket the sequences come first; a task holds those of one bucket at a time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            key, log = (np.concatenate(x) for x in zip(*held))
            used, keys, logs = dealt(spread(key), key, log)
            return pa.RecordBatch.from_arrays([pa.array([-1] * len(used), pa.int64()), used, keys, logs, pa.array([b""] * len(used), pa.binary())], names)

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            if b.num_rows:
                held.append((b.column("key").to_numpy().view(np.uint64), b.column("log").to_numpy()))
            if sum(len(k) for k, _ in held) > 4 * FOLD:
                yield rows()
                held.clear()
        if held:
            yield rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # by the first text of an array

        def out() -> Iterator[pa.RecordBatch]:
            while sums:
                first, total = zip(*(sums.popitem() for _ in range(min(len(sums), BUCKETS))))
                yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(map(packed, total), pa.binary())], ["row", "sums"])

        now, parts, key, log = None, [], None, None
        for b in batches:
            for first, g, keys, texts, times in zip(*(c.to_pylist() for c in b.columns)):
                if g != now:
                    now, parts, key = g, [], None
                if first < 0:
                    parts.append((unpacked(keys, np.uint64), unpacked(texts, np.int64)))
                    continue
                if key is None:
                    key, log = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    order = np.argsort(key)
                    key, log = np.append(key[order], np.uint64(2**64 - 1)), np.append(log[order], 0)  # no sequence has eight bytes
                    parts = []
                asked, text = unpacked(keys, np.uint64), unpacked(texts, np.int64)
                at = np.searchsorted(key, asked)
                value = np.where(key[at] == asked, log[at], 0) * unpacked(times, np.int64)
                np.add.at(longer(sums, first, int(text.max()) + 1), text, value)
            if sum(map(len, sums.values())) > SUMS:
                yield from out()
        yield from out()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for first, part in zip(*(c.to_pylist() for c in b.columns)):
                part = unpacked(part, np.int64)
                longer(sums, first, len(part))[: len(part)] += part
        while sums:
            first, total = zip(*(sums.popitem() for _ in range(min(len(sums), BUCKETS))))
            row, total = np.concatenate([np.arange(f, f + len(x)) for f, x in zip(first, total)]), np.concatenate(total)
            some = total != 0
            yield pa.RecordBatch.from_arrays([pa.array(row[some]), pa.array(total[some])], ["row", "score_cold"])

    names = ["row", "g", "keys", "texts", "times"]
    schema = "row long, g int, keys binary, texts binary, times binary"
    both = values.select("key", "log").mapInArrow(pack, schema).unionByName(entries.select(*names))
    found = both.repartition(JOINED, "g").sortWithinPartitions("g", "row").mapInArrow(run, "row long, sums binary")
    return cut_arrays(found.repartition("row").mapInArrow(added, "row long, score_cold long"), "lm-sums")


class Model:
    """The sequences (key, n) with their customers, and the probability of every symbol after every one."""

    def __init__(self, sequences: DataFrame, groups: int, above: np.ndarray) -> None:
        self.sequences, self.groups, self.above = sequences, groups, above

    def table(self, asked: DataFrame | None = None) -> DataFrame:
        """(key, n, log) of all sequences, those ``asked`` for (key) too: log10 times UNIT of the probability of the last symbol after the others."""
        rows = self.sequences
        if asked is not None:
            rows = rows.unionByName(asked.select("key", F.lit(0).cast("long").alias("n"))).groupBy("key").agg(F.sum("n").alias("n"))
        return cut(sampled(rows, self.groups, self.above, BURN + SAMPLES, SAMPLES), "lm-model")

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Of the last symbol of each sequence; for a look at a few."""
        asked = self.sequences.sparkSession.createDataFrame(pa.table({"key": signed(keys)}))
        found = self.table(asked).join(asked.distinct(), "key", "left_semi").toArrow()  # at most the sequences asked for
        log = dict(zip(found.column("key").to_pylist(), found.column("log").to_pylist()))
        return np.array([log[k] for k in signed(keys).to_pylist()]) / UNIT


def pairs(rows: DataFrame) -> np.ndarray:
    """Customers ``n`` of every pair of symbols by the rows (key, n)."""
    found = rows.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most 65536 rows
    out = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    out[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return out


def train(counts: DataFrame) -> Model:
    """The model of ``corpus_counts``."""
    sequences = counts.where(F.col("kind") == GRAMS).select("key", "n")
    customers = sequences.where("n > 0")
    # a power of two, and no more than there are buckets
    groups = min(BUCKETS, 1 << (customers.count() // GROUP).bit_length())
    rng = np.random.default_rng([SEED, SYMBOLS])
    kinds = customers.select(F.col("key").bitwiseAND(F.lit((1 << 24) - 1)).alias("key")).distinct()
    above = seated_top(pairs(kinds.select(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("key"), F.lit(1).alias("n"))), rng)
    for _ in range(ROUNDS - 1):
        above = seated_top(pairs(sampled(customers, groups, above, BURN, 0)), rng)
    return Model(sequences, groups, above)


def scores(docs: DataFrame, counts: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", counted: bool = False) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row; ``counted``: the counts list all sequences of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = None if counted else corpus_counts(rows, F.lit(False)).where(F.col("kind") == GRAMS).select("key")
    values = model.table(asked).withColumn("size", F.when(F.col("n") > 0, F.floor(F.log2("n"))).otherwise(-1))
    left, least = 1 << FREQUENT, 64
    for size, n in sorted(values.where("size >= 0").groupBy("size").count().collect(), reverse=True):  # at most 63 rows
        left -= n
        if left < 0:
            break
        least = size
    frequent = values.where(F.col("size") >= least).select("key", "log").toArrow()  # at most 2**FREQUENT rows
    vocabulary = counts.where(F.col("kind") == WORDS).select("key", "n")
    n_all, n_kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot = vocabulary.where(F.col("n") * (1 << HOT) >= n_all).toArrow()  # at most 2**HOT rows
    below = n_all + 0.1 * (n_kinds + 1)
    unsigned = lambda t: t.column("key").to_numpy().astype(np.int64).view(np.uint64)
    shared = Shared(docs.sparkSession, (
        Lookup(unsigned(frequent)), frequent.column("log").to_numpy(), Lookup(unsigned(hot)), np.log10((hot.column("n").to_numpy() + 0.1) / below)))
    schema = (f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_hot long, base_hot double, score_hot long, "
              "cold array<struct<key:bigint,times:bigint>>, g int, keys binary, texts binary, times binary")
    names = ["row", "doc_id", "n_tokens", "n_hot", "base_hot", "score_hot", "cold", "g", "keys", "texts", "times"]
    cold_type = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences, log, known, value = shared.value
        row = TaskContext.get().partitionId() << 33
        for b in slices(batches, limit=SLICE):
            kinds: dict[bytes, int] = {}
            ids, parts = [], []
            for t in b.column("text").to_pylist():
                words = [*words_of(t), END]
                ids.append(np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words)))
                parts.append(spelled(words[:-1]))
            # sequences by their frequency, the rare ones to be joined
            key, size = places(parts)
            at = sequences.find(key)
            rare = np.flatnonzero(at < 0)
            found = log[at] if len(log) else np.zeros(len(at), np.int64)
            found[rare] = 0
            score = np.add.reduceat(found, np.cumsum(size) - size)
            rare_keys, which = np.unique(key[rare], return_inverse=True)
            if len(rare):
                pair, times = np.unique(which * len(size) + np.searchsorted(np.cumsum(size), rare, "right"), return_counts=True)
                each = rare_keys[pair // len(size)]
                used, *arrays = dealt(spread(each), each, pair % len(size), times.astype(np.int64))
                none = [pa.nulls(len(used), t) for t in (b.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.float64(), pa.int64(), cold_type)]
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(used), pa.int64()), *none, used, *arrays], names)
            # words likewise
            key = np.fromiter(map(xxhash.xxh64_intdigest, kinds), np.uint64, len(kinds))
            at = known.find(key)
            each = np.concatenate(ids)
            n = np.array([len(i) for i in ids], np.int64)
            begin = np.cumsum(n) - n
            is_hot = at >= 0
            base = np.add.reduceat(np.where(is_hot[each], value[at[each]] if len(value) else 0.0, 0.0), begin)
            n_hot = np.add.reduceat(is_hot[each].astype(np.int64), begin)
            cold = ~is_hot[each]
            of = np.repeat(np.arange(len(n)), n)[cold]
            pair, times = np.unique(of * len(key) + each[cold], return_counts=True)
            ends = np.searchsorted(pair // len(key), np.arange(len(n) + 1)).astype(np.int32)
            entry = pa.StructArray.from_arrays([signed(key[pair % len(key)]), pa.array(times.astype(np.int64))], ["key", "times"])
            none = [pa.nulls(len(n), t) for t in (pa.int32(), pa.binary(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(n))), b.column("doc_id"), pa.array(n), pa.array(n_hot), pa.array(base), pa.array(score),
                 pa.ListArray.from_arrays(pa.array(ends), entry), *none], names)
            row += len(n)

    both = cut(rows.mapInArrow(run, schema), "lm-scored")
    scored, entries = both.where("g IS NULL").drop("g", "keys", "texts", "times"), both.where("g IS NOT NULL")
    rare = scored.select("row", F.explode("cold").alias("c")).select("row", "c.*").join(vocabulary.select("key", F.col("n").alias("value")), "key", "left")
    log = F.log10((F.coalesce("value", F.lit(0)) + 0.1) / F.lit(below))
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * log).alias("base_cold"), F.sum(F.when(F.col("value") > 0, F.col("times"))).alias("n_cold"))
    sums = summed_logs(entries, values.where(F.col("size") < least))
    return scored.drop("cold").join(rare, "row", "left").join(sums, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_hot") + F.coalesce("n_cold", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base_hot") + F.coalesce("base_cold", F.lit(0.0))).alias("base_score"),
        ((F.col("score_hot") + F.coalesce("score_cold", F.lit(0))) / UNIT).alias("score"))


def held_out(doc_id: Column) -> Column:
    return id_hash(doc_id) % 10 == 0


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = corpus_counts(docs, ~held_out(F.col("doc_id")))
    found = scores(docs, counts, train(counts), counted=True)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
