import re

import numpy as np
import xxhash

from fieldnotes.llm import simhash
from tests.llm.helpers import union_find


def brute_fingerprint(text, width=4):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, budget=4):
    first = {}
    for i, f in zip(ids, fps):
        first[f] = min(i, first.get(f, i))
    kinds = sorted(first)
    edges = [(a, b) for x, a in enumerate(kinds) for b in kinds[:x] if (a ^ b).bit_count() <= budget]
    root = union_find(edges)
    low = {}
    for f in kinds:
        r = root.get(f, f)
        low[r] = min(first[f], low.get(r, first[f]))
    return [low[root.get(f, f)] for f in fps]


def test_query_against_brute_force(spark, sf_dir):
    from fieldnotes.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fps = [brute_fingerprint(d["text"]) for d in docs]
    want = dict(zip([d["doc_id"] for d in docs], zip([f"{f:016x}" for f in fps], brute_components([d["doc_id"] for d in docs], fps))))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op6_simhash_trie"](spark, sf_dir).collect()} == want
    assert len({c for _, c in want.values()}) < len(docs)


def planted(rng, n):
    x = rng.integers(0, 2**64, n, dtype=np.uint64)
    y = x[: n // 3].copy()
    for _ in range(5):
        y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64) * (rng.random(len(y)) < 0.7)
    center = np.uint64(0x0123456789ABCDEF)
    dense = [center ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 64, (n // 3, 2))]
    return np.unique(np.concatenate([x, y, np.array(dense, np.uint64), np.array([0, 3, 15, 31], np.uint64)]))


def test_trie_against_all_pairs(spark):
    """All roots small, and with roots split twice: the same components as all pairs."""
    x = planted(np.random.default_rng(7), 900)
    ids = x.astype(object)
    want = dict(zip(ids, brute_components(ids, [int(i) for i in ids])))
    fps = spark.createDataFrame([(int(i),) for i in x.view(np.int64)], "fp long")
    for most in (simhash.MOST, 12):
        links = [(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.trie_links(fps, 4, most).collect()]
        root = union_find(links)
        low = {}
        for i in sorted(int(i) for i in ids):
            low.setdefault(root.get(i, i), i)
        assert {int(i): low[root.get(int(i), int(i))] for i in ids} == {int(a): int(b) for a, b in want.items()}
        assert all((a ^ b).bit_count() <= 4 * len(x) for a, b in links)


def test_split_roots_keep_isolated_links(spark):
    """Pairs that agree in one block only and differ by one bit in each other one, in roots that are split once and twice."""
    rng = np.random.default_rng(9)
    pairs = []
    for free in (51, 38):  # the leading 13 or 26 bits, which hold the first one or two blocks, are the same in all of a group
        low = rng.integers(0, 2**free, 40, dtype=np.uint64)
        for x in (np.uint64(0x9E3779B97F4A7C15) >> np.uint64(free) << np.uint64(free)) | low:
            y = int(x)
            for bit in (7, 20, 30, 45) if free == 51 else (3, 10, 21, 32):  # the first block is bits 52 to 63
                y ^= 1 << bit
            pairs.append((int(x), y))
    fps = np.array(sorted({f for p in pairs for f in p}), np.uint64)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    root = union_find([(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.trie_links(df, 4, 12).collect()])
    assert all(root.get(x, x) == root.get(y, y) for x, y in pairs)


def test_links_below_is_a_forest():
    x = planted(np.random.default_rng(8), 600)
    a, b = simhash.links_below(x, np.array([0, len(x)]), 4)
    assert len(a) == len(set(a.tolist()))  # one link per linked entry: no pairs of a group


def test_edges(spark, weird, docs_of):
    docs, rows = weird
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by[1] == by[2] == by[3] == {(0, 1)}  # no word: fingerprint zero, linked like any other
    assert {c for _, c in by[4]} == {4} and (0, 1) in by[None] and {c for _, c in by[8]} == {7}
    stays = simhash.drop_near_duplicates(docs)
    assert stays.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in stays.collect())
    assert ids.count("4") == 2 and "2" not in ids and "8" not in ids and "None" not in ids
    assert simhash.near_duplicates(docs_of([])).count() == 0
    alone = simhash.near_duplicates(docs_of([(None, "a lonely text of words"), (None, "a lonely text of words")])).collect()
    assert [(r["doc_id"], r["component_id"]) for r in alone] == [(None, None)] * 2


def test_fingerprints_of_odd_texts():
    for text in (None, "", "one", "One two THREE", "a b c d", "É Ü x y z ß\x1fq", "x " * 40_000):
        assert simhash.fingerprint(text, 4) % 2**64 == brute_fingerprint(text)


def test_columns_named_as_the_helpers(spark, docs_of):
    docs = docs_of([(1, "one two three four five"), (2, "one two three four five"), (3, "six seven eight nine ten")])
    docs = docs.selectExpr("*", "'mine' AS stays", "'mine' AS _stays")
    out = simhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted((r.doc_id, r.stays, r._stays) for r in out.collect()) == [(1, "mine", "mine"), (3, "mine", "mine")]
