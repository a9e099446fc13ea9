"""Exact repeated-substring dedup with suffix arrays over shards of the corpus.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else (in any text, the same one included) is removed; texts are UTF-8 bytes and
strings never cross texts.

Which bytes have to be compared with which is settled by a key that depends on
a string alone: the smallest hash of the 32-byte grams in it. Equal strings have
equal keys, and neighbouring strings mostly share one, so a text falls into
runs of strings with one key, about one run per 85 bytes. Only runs whose key
occurs again are looked at:

1. keys are counted over the whole corpus (folded in the tasks), and the runs
   whose key occurs twice are kept with a hash of their bytes;
2. equal runs are folded into one with a count, so copies cost one run;
3. the different runs of a key meet in one shard. A shard concatenates its runs
   and sorts their suffixes (Larsson-Sadakane refinement, only groups still
   tied are sorted again), takes the common prefixes by Kasai's scan, and so
   finds the strings with two or more occurrences. A key with more bytes than
   ``SHARD`` is dealt to several shards; these pass on one fingerprint per
   distinct string, ranges of which are merged by binary search;
4. the strings found are written back to every copy of their run and joined
   into spans per text.

A shard holds ``SHARD`` bytes (or one run), hot passages being folded before
the shuffle. A run is cut at ``PIECE`` bytes, so long texts take bounded memory.

Defined cases: NULL texts are empty; texts shorter than ``length`` are kept
whole; repeated rows and copies are occurrences of each other, so they lose all
bytes if they have ``length`` of them; NULL ids are kept; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import KeyFilter, Shared, cut, key_filter, slices, table

LENGTH = 200
GRAM = 32
PIECE = 4 << 20  # bytes of a text worked on at once
SHARD = 2 << 20  # bytes of runs in a shard
END = 0xFF  # between runs: no byte of UTF-8
LANE = 128  # suffixes a lane of Kasai's scan goes through


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``width`` neighbours, by doubling."""
    w = 1
    while 2 * w <= width:
        x, w = best(x[:-w], x[w:]), 2 * w
    rest = width - w
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of every ``GRAM`` bytes (a power of two), by doubling."""
    h, k, p = b.astype(np.uint64) + np.uint64(1), 1, np.full(1, 0x9E3779B97F4A7C15, np.uint64)
    while k < GRAM:
        h, k = h[:-k] * p + h[k:], 2 * k
        p = p * p
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def runs(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first start, last start, key, whether strings of the run may repeat within it) of the runs of a text."""
    width = length - GRAM + 1
    for at in range(0, max(0, len(data) - length + 1), PIECE):
        h = gram_hashes(np.frombuffer(data, np.uint8, min(PIECE + length - 1, len(data) - at), at))
        low = sliding(h, width, np.minimum)
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        last = np.append(first[1:], len(low)) - 1
        key = low[first]
        # a string occurs twice within a run only if the smallest hash does
        pad = np.zeros(width - 1, np.uint64)
        least = np.flatnonzero(sliding(np.concatenate([pad, low, pad]), width, np.maximum) == h)
        again = np.zeros(len(first), bool)
        if len(least) > len(first):
            lo, hi = np.searchsorted(least, first), np.searchsorted(least, last + width)
            again[:] = [np.count_nonzero(h[least[i:j]] == k) > 1 for i, j, k in zip(lo.tolist(), hi.tolist(), key)]
        yield first + at, last + at, key.view(np.int64), again


def suffix_array(b: np.ndarray) -> np.ndarray:
    """Start positions in suffix order (the end sorts first), by Larsson-Sadakane refinement: tied groups only are
    sorted again, by the group of the suffix as far ahead as is known to agree, which doubles each time."""
    n, known = len(b), 8
    words = eight(b)
    order = np.argsort(words)
    new = np.concatenate([[True], words[order[1:]] != words[order[:-1]]])
    group = np.empty(n + 1, np.int64)
    group[n] = -1
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    group[order] = start
    while True:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            return order
        at = order[tied]
        ahead = group[np.minimum(at + known, n)]
        own = group[at]
        again = np.argsort(own * (n + 1) + ahead + 1)
        at, own, ahead = at[again], own[again], ahead[again]
        order[tied] = at
        differs = np.concatenate([[True], (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])])
        new[tied] |= differs
        begins = np.maximum.accumulate(np.where(differs, tied, 0))
        group[at] = begins
        known *= 2


def eight(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, big-endian; zeros past the end."""
    h = np.concatenate([b, np.zeros(7, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        h = (h[:-k] << np.uint64(8 * k)) | h[k:]
    return h


def common_prefixes(b: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix in order shares with the one before it, up to ``most``.

    Kasai's scan goes through the text: if a suffix shares l bytes with its predecessor, the next one shares l - 1
    at least. Lanes of ``LANE`` positions are scanned side by side, eight bytes at a time.
    """
    n = len(b)
    words = np.concatenate([eight(b), np.zeros(most + 8, np.uint64)])
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, LANE)
    have = np.zeros(len(starts), np.int64)
    for j in range(min(LANE, n)):
        p = starts + j
        p, have = p[p < n], have[: np.count_nonzero(p < n)]
        r = rank[p]
        q = order[np.maximum(r - 1, 0)]
        size = np.where(r > 0, have, 0)
        limit = np.where(r > 0, np.minimum(most, n - np.maximum(p, q)), 0)
        go = np.flatnonzero(size < limit)
        while len(go):
            x = words[p[go] + size[go]] ^ words[q[go] + size[go]]
            same = np.where(x == 0, 8, leading_zero_bytes(x))
            size[go] = np.minimum(size[go] + same, limit[go])
            go = go[(same == 8) & (size[go] < limit[go])]
        size = np.minimum(size, limit)
        out[r] = size
        have = np.maximum(size - 1, 0)
    return out


def leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    n = np.zeros(len(x), np.int64)
    for shift, step in ((32, 4), (16, 2), (8, 1)):
        high = x >> np.uint64(64 - 8 * step)
        zero = high == 0
        n += np.where(zero, step, 0)
        x = np.where(zero, x << np.uint64(shift), x)
    return n


def repeats(contexts: list[bytes], copies: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a shard of runs: (run, offset, group, size of the group counting copies) of each string, and the offset of each run."""
    b = np.frombuffer(bytes([END]).join(contexts) + bytes([END]), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order = suffix_array(b)
    shared = common_prefixes(b, order, length)
    group = np.cumsum(shared < length)  # in suffix order, equal strings stand together
    run = np.searchsorted(starts, order, "right") - 1
    offset = order - starts[run]
    whole = offset <= sizes[run] - length  # a string of the run, not its tail
    run, offset, group = run[whole], offset[whole], group[whole]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, np.int64)
    weight = np.add.reduceat(np.array(copies, np.int64)[run], first) if len(first) else first
    return run, offset, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group)))), weight, starts


def stretches(run: np.ndarray, offset: np.ndarray) -> list[tuple[int, int, int]]:
    """(run, first, last) of consecutive offsets."""
    order = np.lexsort((offset, run))
    run, offset = run[order], offset[order]
    cuts = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (offset[1:] != offset[:-1] + 1)]))
    ends = np.append(cuts[1:], len(run)) - 1
    return list(zip(run[cuts].tolist(), offset[cuts].tolist(), offset[ends].tolist()))


def rows_of(names: str, rows: list[tuple]) -> pa.RecordBatch:
    names_, kinds = zip(*[x.split() for x in names.split(", ")])
    of = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    cols = list(zip(*rows)) if rows else [[] for _ in names_]
    return pa.RecordBatch.from_arrays([pa.array(list(c), of[k]) for c, k in zip(cols, kinds)], list(names_))


FOUND = "key long, run long, first int, last int"
PROBES = "key long, run long, first int, x long, y long, done boolean"


def count_keys(texts: DataFrame, length: int) -> DataFrame:
    """(key, n): how often each key occurs, a run that may repeat within itself counting twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keys = [np.empty(0, np.int64)]
            for t in b.column("text").to_pylist():
                for _, _, key, again in runs(t.encode(), length):
                    keys += [key, key[again]]
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def shared_runs(texts: DataFrame, keys: KeyFilter, length: int) -> DataFrame:
    """(k, key, run (hash of its bytes), first, last, again) of the runs whose key may occur twice."""
    shared = Shared(texts.sparkSession, keys)
    names = ["k", "key", "run", "first", "last", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in slices(batches):
            for k, t in zip(b.column("k").to_pylist(), b.column("text").to_pylist()):
                data = t.encode()
                for first, last, key, again in runs(data, length):
                    keep = shared.value.may_hold(key)
                    first, last, key, again = first[keep], last[keep], key[keep], again[keep]
                    hashes = np.array([digest(data[i:j]) for i, j in zip(first.tolist(), (last + length).tolist())], np.uint64).view(np.int64)
                    cols = [np.full(len(key), k), key, hashes, first.astype(np.int32), last.astype(np.int32), again]
                    if len(key):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    return texts.select("k", "text").mapInArrow(regroup(run), "k long, key long, run long, first int, last int, again boolean")


def regroup(run: Callable) -> Callable:
    """``run`` with its small batches joined into larger ones."""

    def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n > 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return larger


def sort_shards(contexts: DataFrame, length: int, n_shards: int, shard: int = SHARD) -> DataFrame:
    """What the shards find: ``found`` stretches, and ``probes`` for strings of keys that lie in several shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, int, bool]] = {}
        size = 0

        def work() -> Iterator[pa.RecordBatch]:
            ids, parts = list(held), list(held.values())
            run, offset, group, weight, _ = repeats([p[0] for p in parts], [p[1] for p in parts], length)
            twice = weight[group] > 1
            found = [(*ids[i], a, b, None, None, None) for i, a, b in stretches(run[twice], offset[twice])] if twice.any() else []
            split = np.array([p[2] for p in parts])[run] if len(run) else np.empty(0, bool)
            probes = []
            if split.any():  # one string per group
                own, at = np.unique(group[split], return_index=True)
                for g, i in zip(own.tolist(), np.flatnonzero(split)[at].tolist()):
                    o = int(offset[i])
                    x = xxhash.xxh3_128_intdigest(parts[run[i]][0][o : o + length])
                    probes.append((*ids[run[i]], o, o, signed(x >> 64), signed(x & (1 << 64) - 1), bool(weight[g] > 1)))
            yield rows_of("key long, run long, first int, last int, x long, y long, done boolean", found + probes)

        for b in batches:
            for key, salt, rid, n, split, data in zip(*(b.column(c).to_pylist() for c in ("key", "salt", "run", "n", "split", "data"))):
                if held and size + len(data) > shard and (key, salt) != last:
                    yield from work()
                    held.clear()
                    size = 0
                if (key, rid) not in held:  # copies of a text bring the same run
                    held[key, rid] = (data, n, split)
                    size += len(data)
                last = (key, salt)
        if held:
            yield from work()

    dealt = contexts.repartition(n_shards, "key", "salt").sortWithinPartitions("key", "salt")
    return dealt.mapInArrow(run, "key long, run long, first int, last int, x long, y long, done boolean")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def merge_shards(probes: DataFrame) -> DataFrame:
    """The strings that several shards hold: each shard's sorted fingerprints are looked up in all of them by binary search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(t: pa.Table) -> pa.RecordBatch:
            x, y = (t.column(c).to_numpy() for c in ("x", "y"))
            kinds, code = np.unique(np.stack([x, y], axis=1), axis=0, return_inverse=True)
            code = np.sort(code.ravel()), code.ravel()
            n = np.searchsorted(code[0], code[1], "right") - np.searchsorted(code[0], code[1], "left")
            t = t.filter(pa.array((n > 1) & ~np.array(t.column("done").to_pylist(), bool)))
            return t.select(["key", "run", "first", "last"]).combine_chunks()

        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) > 100_000:
                t = pa.Table.from_batches(held)
                n = pa.compute.index(t.column("x"), t.column("x")[-1]).as_py()
                if n:
                    yield from work(t.slice(0, n)).to_batches()
                held = t.slice(n).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches()

    return probes.repartition("x").sortWithinPartitions("x").mapInArrow(run, FOUND)


def repeated_spans(texts: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(k, spans): the maximal runs of bytes to remove, ``spans`` an array of (start, stop), of the texts that have any.

    ``texts`` is (k, text): ``k`` the XXH64 of the text, a row per document.
    """
    again = key_filter(count_keys(texts, length).where("n > 1").select("key"))
    found = cut(shared_runs(texts, again, length), "suffix-runs")
    kinds = found.groupBy("key", "run").agg(F.count("*").alias("n"), F.max("again").alias("again"), F.min(F.struct("k", "first", "last")).alias("one"))
    kinds = cut(kinds, "suffix-kinds")
    per_key = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum(F.col("one.last") - F.col("one.first") + length).alias("bytes"))
    per_key = per_key.where("kinds > 1").withColumn("shards", F.ceil(F.col("bytes") / shard))
    compared = kinds.join(per_key, "key", "left").where("shards IS NOT NULL OR again")
    compared = compared.select("key", "run", "n", "one.*", F.coalesce("shards", F.lit(1)).alias("shards"))
    compared = cut(compared.withColumn("salt", F.pmod("run", "shards")), "suffix-compared")
    total = compared.agg(F.coalesce(F.sum(F.col("last") - F.col("first") + length), F.lit(0))).first()[0]

    # the bytes of the runs to compare, from one copy of each
    wanted = compared.groupBy("k").agg(F.collect_list(F.struct("key", "run", "n", "salt", "first", "last", (F.col("shards") > 1).alias("split"))).alias("runs"))
    near = keep_keys(texts, key_filter(compared.select("k")))

    def slice_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=1 << 20):
            rows = []
            for t, wanted in zip(b.column("text").to_pylist(), b.column("runs").to_pylist()):
                data = t.encode()
                for r in wanted:
                    part = data[r["first"] : r["last"] + length]
                    if signed(xxhash.xxh3_64_intdigest(part)) == r["run"]:  # else another text of the same k
                        rows.append((r["key"], r["salt"], r["run"], r["n"], r["split"], part))
            yield rows_of("key long, salt long, run long, n long, split boolean, data binary", rows)

    contexts = near.join(wanted, "k").select("text", "runs").mapInArrow(slice_out, "key long, salt long, run long, n long, split boolean, data binary")
    local = cut(sort_shards(contexts, length, max(1, -(-total // shard)), shard), "suffix-shards")
    strings = local.where("x IS NULL").select("key", "run", "first", "last").unionByName(
        merge_shards(local.where("x IS NOT NULL").select("key", "run", "first", "last", "x", "y", "done")))
    strings = strings.unionByName(kinds.where("n > 1").select("key", "run", F.lit(0).alias("first"), (F.col("one.last") - F.col("one.first")).alias("last")))

    runs_ = found.select("k", "key", "run", F.col("first").alias("at"))
    spans = runs_.join(strings, ["key", "run"]).select("k", (F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + length).alias("stop"))
    spans = spans.distinct().groupBy("k").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))  # as many as a text has runs
    return cut(spans.select("k", joined("spans").alias("spans")), "suffix-spans")


def joined(spans: str) -> F.Column:
    """Sorted spans with those that touch or overlap made one."""
    item = "struct<start:int,stop:int>"
    return F.expr(f"""aggregate({spans}, cast(struct(array() AS done, cast(null AS {item}) AS open) AS struct<done:array<{item}>,open:{item}>),
        (acc, x) -> CASE WHEN acc.open IS NULL THEN named_struct('done', acc.done, 'open', named_struct('start', x.start, 'stop', x.stop))
                         WHEN x.start <= acc.open.stop THEN named_struct('done', acc.done, 'open', named_struct('start', acc.open.start, 'stop', greatest(acc.open.stop, x.stop)))
                         ELSE named_struct('done', concat(acc.done, array(acc.open)), 'open', named_struct('start', x.start, 'stop', x.stop)) END,
        acc -> concat(acc.done, array(acc.open)))""")


def keep_keys(texts: DataFrame, keys: KeyFilter) -> DataFrame:
    """The rows of ``texts`` whose k the filter may hold."""
    shared = Shared(texts.sparkSession, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(shared.value.may_hold(b.column("k").to_numpy().astype(np.int64))))

    return texts.mapInArrow(run, texts.schema)


def without(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(k, spans, kept): the remaining bytes of the texts that lose any, one row per text."""
    near = keep_keys(texts, key_filter(spans.select("k")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                data, at, parts = t.encode(), 0, []
                for s in spans:
                    parts.append(data[at : s["start"]])
                    at = s["stop"]
                kept.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("spans"), pa.array(kept, pa.binary())], ["k", "spans", "kept"])

    return near.join(spans, "k").select("k", "spans", "text").mapInArrow(run, "k long, spans array<struct<start:int,stop:int>>, kept binary")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("k"), text.alias("text"))


def op9_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "documents"))
    spans = repeated_spans(docs.select("k", "text"))
    cuts = without(docs.select("k", "text"), spans).select(
        "k", F.octet_length("kept").cast("long").alias("n_kept"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("sha")).distinct()
    whole = docs.select("doc_id", "k", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha"))
    return whole.join(cuts, "k", "left").select(
        "doc_id", "n_bytes", F.coalesce(F.col("n_bytes") - F.col("n_kept"), F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("sha", "whole_sha").alias("kept_sha256"))
