import hashlib
from collections import Counter

import numpy as np

from fieldnotes.llm import suffix
from tests.llm.helpers import prose


def brute(texts, length):
    """Covered bytes of every text, as a mask."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    masks = []
    for d in data:
        step = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                step[i] += 1
                step[i + length] -= 1
        masks.append(np.cumsum(step[:-1]) > 0)
    return masks


def spans_of(mask):
    edge = np.diff(np.concatenate([[0], mask.astype(int), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def check(spark, texts, length, shard=suffix.SHARD):
    docs = suffix.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    found = {r["k"]: [tuple(s) for s in r["spans"]] for r in suffix.repeated_spans(docs.select("k", "text"), length, shard).collect()}
    keys = {r["doc_id"]: r["k"] for r in docs.collect()}
    assert [found.get(keys[i], []) for i in range(len(texts))] == [spans_of(m) for m in brute(texts, length)]


def test_random_texts(spark):
    rng = np.random.default_rng(9)
    pool = [prose(rng, 80) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, int(rng.integers(1, 30)))]
        for j in rng.integers(0, len(pool), 3):
            a = int(rng.integers(0, 200))
            parts += [pool[j][a : a + int(rng.integers(20, 300))], prose(rng, 4)]
        texts.append("".join(parts))
    texts += texts[:4] + ["ab" * 300, "a" * 500 + "b" + "a" * 90, "é" * 70 + prose(rng, 9), None, "", "x" * 99]
    check(spark, texts, 100)
    check(spark, texts, 100, shard=2000)  # keys split over shards, merged by search


def test_exact_lengths(spark):
    rng = np.random.default_rng(10)
    s = prose(rng, 60)[:201]
    check(spark, [f"1{s[:200]}2", f"3{s[:200]}4", f"5{s[:199]}6", s[1:], "é" + s[:199]], 200)


def test_query_against_brute_force(spark, sf_dir):
    from fieldnotes.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    masks = brute([d["text"] for d in docs], 200)
    rows = {r["doc_id"]: r for r in QUERIES["op9_suffix_arrays"](spark, sf_dir).collect()}
    for d, mask in zip(docs, masks):
        data, r = np.frombuffer(d["text"].encode(), np.uint8), rows[d["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), int(mask.sum()), len(spans_of(mask)))
        assert r["kept_sha256"] == hashlib.sha256(data[~mask].tobytes()).hexdigest()
    assert sum(r["n_removed"] for r in rows.values()) > 10_000


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(11)
    for n in (1, 2, 7, 8, 9, 300, 1500):
        b = np.append(rng.integers(97, 99, n).astype(np.uint8), np.uint8(suffix.END))
        data = b.tobytes()
        order = suffix.suffix_array(b)
        assert order.tolist() == sorted(range(len(b)), key=lambda i: data[i:])
        lcp = [0]
        for x, y in zip(order[:-1], order[1:]):
            m = 0
            while m < 20 and max(x, y) + m < len(data) and data[x + m] == data[y + m]:
                m += 1
            lcp.append(m)
        assert suffix.common_prefixes(b, order, 20).tolist() == lcp


def test_edges(spark, weird, docs_of):
    docs, rows = weird
    keyed = suffix.keyed(docs)
    check(spark, [r[1] for r in rows], 200)
    spans = suffix.repeated_spans(keyed.select("k", "text"))
    cuts = suffix.without(keyed.select("k", "text"), spans).collect()
    assert {bytes(r["kept"]) for r in cuts if not r["kept"]} == {b""} and len(cuts) >= 5
    empty = suffix.keyed(docs_of([]))
    assert suffix.repeated_spans(empty.select("k", "text")).count() == 0
