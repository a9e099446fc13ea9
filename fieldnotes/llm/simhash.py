"""SimHash near-duplicates by a binary trie self-join.

Fingerprints: ASCII letters lower-cased, shingles of ``width`` words joined by
a space (repeats included; a shorter text is one shingle), XXH64 with seed 42
of each; a bit is 1 if it is set in over half of the hashes. A text without
words, or NULL, has fingerprint zero. Documents link at ``budget`` or fewer
differing bits.

The join works on the distinct fingerprints, so a group of copies is one entry.
A trie over their bits is walked with itself: pairs of nodes go down together,
the bits in which their paths differ are added up, and a pair is dropped as
soon as they exceed the budget. Spark deals out the walk by the trie's roots:
of ``budget + 1`` bit blocks two linked fingerprints agree in at least one, so
each fingerprint goes once per block to the root of that block's value. A root
with more than ``most`` fingerprints is split the same way (twice at most): the
bits that it leaves free are cut into ``budget + 1`` new blocks, of which two
linked fingerprints again agree in at least one, so every link is kept. A task holds the roots it is
walking and a bounded frontier of node pairs, and returns a spanning forest of
the links it found, never all pairs of a group. Linked fingerprints are then
joined into components over the whole corpus.

Defined cases: repeated rows link like any copies; a NULL id keeps its row and
the component of its copies (NULL when it has no other); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm.util import components, cut, fresh, slices, table

BITS = 64
SEED = 42
MOST = 4096  # fingerprints of a root before it is split by its remaining bits
FRONTIER = 1 << 18  # node pairs walked at once


def fingerprint(text: str | None, width: int) -> int:
    """SimHash of a whole text as a signed 64-bit integer."""
    words = text.encode().lower().split() if text else []  # bytes: only ASCII is lower-cased and split at
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    n = max(1, len(words) - width + 1)
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 15):
        block = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[i : min(n, i + (1 << 15))], stops[i : i + (1 << 15)])])
        ones += np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp) for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = [fingerprint(t, width) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def links_below(x: np.ndarray, bounds: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (indices a > b) of the links inside each root ``x[bounds[i]:bounds[i + 1]]``.

    ``x`` (uint64) is sorted within each root. A node is a range of a root that shares its leading
    ``depth`` bits; a pair of nodes carries the number of leading bits in which its two paths differ.
    """
    root = np.arange(len(x))

    def find(i: np.ndarray) -> np.ndarray:
        while True:
            up = root[i]
            if np.array_equal(up, i):
                return i
            i = up

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = find(a), find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))

    def halves(lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        """Where the depth-th bit of a node's sorted range turns 1, by binary search on all nodes at once."""
        lo, hi = lo.copy(), hi.copy()
        bit = np.uint64(BITS - 1 - depth)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            one = ((x[np.minimum(mid, len(x) - 1)] >> bit) & np.uint64(1)).astype(bool)
            hi = np.where(open_ & one, mid, hi)
            lo = np.where(open_ & ~one, mid + 1, lo)

    lo, hi = bounds[:-1], bounds[1:]
    keep = hi - lo > 1
    lo, hi = lo[keep], hi[keep]
    stack = [(0, lo[i : i + FRONTIER], hi[i : i + FRONTIER], lo[i : i + FRONTIER], hi[i : i + FRONTIER], np.zeros(len(lo[i : i + FRONTIER]), np.int64))
             for i in range(0, len(lo), FRONTIER)]
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        am, bm = halves(alo, ahi, depth), halves(blo, bhi, depth)
        same = alo == blo
        parts = [
            (alo, am, blo, bm, err, np.ones_like(same)),
            (am, ahi, bm, bhi, err, np.ones_like(same)),
            (alo, am, bm, bhi, err + 1, np.ones_like(same)),
            (am, ahi, blo, bm, err + 1, ~same),  # of a node with itself the crossing counts once
        ]
        nxt = []
        for p, q, r, s, e, use in parts:
            use = use & (q > p) & (s > r) & (e <= budget) & ~((p == r) & (q - p == 1))
            nxt.append([z[use] for z in (p, q, r, s, e)])
        p, q, r, s, e = (np.concatenate(z) for z in zip(*nxt))
        leaf = (q - p == 1) & (s - r == 1)
        a, b = p[leaf], r[leaf]
        near = np.bitwise_count(x[a] ^ x[b]) <= budget
        unite(a[near], b[near])
        go = np.flatnonzero(~leaf)
        for i in range(0, len(go), FRONTIER):
            j = go[i : i + FRONTIER]
            stack.append((depth + 1, p[j], q[j], r[j], s[j], e[j]))
    top = find(np.arange(len(x)))
    child = np.flatnonzero(top != np.arange(len(x)))
    return child, top[child]


def masks(budget: int, levels: int) -> list[int]:
    """Fixed bits of every node of the split tree. Node 0 fixes none; child j of node p is ``p * (budget + 1) + j + 1``.

    A node's children cut the bits that it leaves free into budget + 1 blocks and fix one block each. Fingerprints that
    agree in a node's bits and differ in at most ``budget`` others thus agree in all bits of one of its children.
    """
    out = [0]
    for p in range(sum((budget + 1) ** i for i in range(levels))):
        free = [b for b in range(BITS - 1, -1, -1) if not out[p] >> b & 1]
        cuts = [len(free) * i // (budget + 1) for i in range(budget + 2)]
        out += [out[p] | sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])]
    return out


def trie_links(fps: DataFrame, budget: int, most: int = MOST) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp``: a spanning forest of each root's."""
    fixed = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m) for m in masks(budget, 3)])

    def keyed(df: DataFrame) -> DataFrame:
        """Roots one level down: the node and its fixed bits."""
        nodes = F.explode(F.array(*[F.col("node") * (budget + 1) + (j + 1) for j in range(budget + 1)]))
        nodes = df.select("fp", nodes.alias("node"))
        return nodes.select("fp", "node", F.concat_ws(":", "node", F.col("fp").bitwiseAND(F.get(fixed, F.col("node")))).alias("key"))

    ready, rest = None, keyed(fps.withColumn("node", F.lit(0)))
    for _ in range(2):
        rest = cut(rest, "trie-roots")
        sizes = rest.groupBy("key").count()
        big = sizes.where(F.col("count") > most).select("key")
        small = rest.join(sizes.where((F.col("count") > 1) & (F.col("count") <= most)).select("key"), "key", "left_semi")
        ready = small if ready is None else ready.unionByName(small)
        rest = rest.join(big, "key", "left_semi")
        if rest.isEmpty():
            break
        rest = keyed(rest)
    else:
        ready = ready.unionByName(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def walk(t: pa.Table) -> pa.RecordBatch:
            key = t.column("key").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            fp = t.column("fp").to_numpy().astype(np.int64)
            x = fp.view(np.uint64)
            order = np.lexsort((x, key))
            x, key = x[order], key[order]
            bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            a, b = links_below(x, bounds, budget)
            return pa.RecordBatch.from_arrays([pa.array(x[a].view(np.int64)), pa.array(x[b].view(np.int64))], ["u", "v"])

        for batch in batches:  # sorted by key: whole roots are walked as soon as enough rows are there
            held.append(batch)
            if sum(h.num_rows for h in held) < 100_000:
                continue
            t = pa.Table.from_batches(held)
            last = t.column("key")[-1].as_py()
            n = int(pa.compute.index(t.column("key"), last).as_py())
            if n:
                yield walk(t.slice(0, n))
            held = t.slice(n).combine_chunks().to_batches()
        if held:
            yield walk(pa.Table.from_batches(held))

    return ready.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 4, budget: int = 4, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id reachable over links."""
    rows = cut(fingerprints(docs, width, id_col, text_col), "simhash")
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(trie_links(firsts.select("fp"), budget), "simhash-components")
    firsts = firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    firsts = cut(firsts, "simhash-roots")
    ids = firsts.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(firsts.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 4, budget: int = 4, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component, with all columns. Rows with that id stay or go together."""
    found = near_duplicates(docs, width, budget, id_col=id_col, text_col=text_col)
    name = fresh("stays", docs)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stays, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")


def op6_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
