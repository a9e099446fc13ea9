import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from fieldnotes.llm import language_model as lm


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def brute_base(docs, trained):
    counts = Counter(w for i, t in docs if trained(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    rows = {}
    for i, t in docs:
        words = tokens(t)
        rows[i] = (len(words), sum(counts[w] > 0 for w in words), total, sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words))
    return rows


def test_base_score_and_gain(spark):
    """The base columns are those of brute force, and the model beats the base on held-out documents."""
    from fieldnotes.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_base(docs, lambda i: zlib.crc32(str(i).encode()) % 10 != 0)
    rows = {r["doc_id"]: r for r in QUERIES["op10_pitman_yor"](spark, d).collect()}
    for i, (n, known, total, base) in want.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0) and r["score"] < 0
    held = [r for r in rows.values() if r["held_out"]]
    assert len(held) > 50 and sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)


def trained(spark, texts):
    counts = lm.corpus_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    return counts, lm.train(counts)


def test_predictions_are_distributions(spark):
    _, model = trained(spark, ["the cat sat on the mat", "the dog sat on the log", "a cat", None, ""] * 20)
    for context in (b"\n" * 6, b"the ca", b"zzzzzz", b"t on t", b"xxxxx\xff"):
        prefix = np.uint64(int.from_bytes(context[-lm.CONTEXT :], "big"))
        keys = (prefix << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** model.log10(keys)).sum() - 1) < 1e-5
    p = lambda c, w: 10 ** model.log10(np.array([int.from_bytes(c + w, "big")], np.uint64))[0]
    assert p(b"the ca", b"t") > 0.9 and p(b"sat on", b" ") > 0.9 > 0.01 > p(b"the ca", b"x")


def test_rare_sequences_go_to_shorter_contexts(spark, monkeypatch):
    """With a high threshold few contexts have dishes; what is left is still a distribution."""
    monkeypatch.setattr(lm, "SHARE", 6)
    texts = ["the cat sat on the mat", "the dog sat on the log", "one two three four five six seven"] * 10
    counts = lm.corpus_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    known = lm.dishes(counts.where("kind = 1").select("key", "n"), sum(len(t) + 2 for t in texts))
    per_level = {r["level"]: r["n"] for r in known.where("direct IS NOT NULL").groupBy("level").count().withColumnRenamed("count", "n").collect()}
    assert per_level.get(6, 0) < 64 and known.where("passed > 0").count() > 0
    model = lm.train(counts)
    for context in (b"the ca", b"sat on", b"e four"):
        keys = (np.uint64(int.from_bytes(context, "big")) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** model.log10(keys)).sum() - 1) < 1e-5


def test_seating(monkeypatch):
    """Tables: one at least, no more than customers, and about as many as seating one by one gives."""
    rng = np.random.default_rng(12)
    customers, base = np.array([0, 1, 2, 50, 400]), np.array([0.2, 0.2, 0.2, 0.2, 0.2])
    mean = np.zeros(5)
    for _ in range(300):
        t = lm.seat(customers, base, np.zeros(5, np.int64), 0.5, np.ones(1), rng)
        assert (t <= customers).all() and (t[1:] >= 1).all() and t[0] == 0
        mean += t / 300
    monkeypatch.setattr(lm, "BATCH", 0.0)
    slow = sum(lm.seat(customers, base, np.zeros(5, np.int64), 0.5, np.ones(1), rng) for _ in range(300)) / 300
    assert np.allclose(mean, slow, rtol=0.25)


def test_edges(spark, weird, docs_of):
    docs, rows = weird
    counts = lm.corpus_counts(docs.select("text"))
    got = lm.scores(docs, counts, lm.train(counts)).collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) for r in got)
    want = brute_base(list(enumerate(r[1] for r in rows)), lambda i: True)
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == sorted(x[:3] for x in want.values())
    again = lm.scores(docs.repartition(5), counts, lm.train(counts)).collect()
    assert sorted(r["score"] for r in again) == sorted(r["score"] for r in got)  # reruns agree
    counts, model = trained(spark, [])
    none = lm.scores(docs, counts, model).collect()
    assert {r["n_known"] for r in none} == {0} and {r["train_tokens"] for r in none} == {0}
    assert math.isclose(min(r["score"] for r in none if r["n_tokens"] == 1), math.log10(1 / 256))
    assert lm.scores(docs_of([]), counts, model).count() == 0


def test_lookup():
    rng = np.random.default_rng(13)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    found = lm.Lookup(keys)
    assert (found.find(keys) == np.arange(len(keys))).all() and (found.find(keys + np.uint64(2**63)) == -1).all()
    assert (lm.Lookup(keys[:0]).find(keys) == -1).all()


def test_rare_sequences_have_dishes(spark, monkeypatch):
    """However rare and whatever the threshold of ``dishes``, a sequence that was seen is predicted by its own context."""
    monkeypatch.setattr(lm, "SHARE", 4)
    monkeypatch.setattr(lm, "FREQUENT", 3)  # most sequences are joined
    monkeypatch.setattr(lm, "GROUP", 8)
    texts = ["the cat sat on the mat"] * 300 + ["quartz"]
    counts, model = trained(spark, texts)
    seen = np.array([int.from_bytes(b"quartz "[:7], "big"), int.from_bytes(b"quartzx", "big")], np.uint64)
    p = 10 ** model.log10(seen)
    assert p[0] > 0.2 > 0.01 > p[1]
    docs = spark.createDataFrame([(1, "quartz"), (2, "the cat"), (3, "zzz quartz")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm.scores(docs, counts, model).collect()}
    for i, t in docs.collect():
        want = model.log10(lm.places([lm.spelled(lm.words_of(t))])[0]).sum()
        assert math.isclose(got[i], want, abs_tol=1e-6)


def test_as_many_groups_as_buckets(spark, monkeypatch):
    """With so many sequences that every bucket is a group, all of them are sampled, and predictions are distributions."""
    monkeypatch.setattr(lm, "GROUP", 1)
    counts, model = trained(spark, ["the cat sat on the mat", "the dog sat on the log", "one two three four five six seven", "pack my box with five dozen liquor jugs", "how quickly daft jumping zebras vex"])
    want = [tuple(r) for r in counts.where("kind = 1").select("key", "n").collect()]
    assert len(want) >= lm.BUCKETS // 2 and model.groups == lm.BUCKETS
    assert sorted((r["key"], r["n"]) for r in model.table().collect()) == sorted(want)
    for context in (b"the ca", b"zzzzzz", b"x with"):
        keys = (np.uint64(int.from_bytes(context, "big")) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** model.log10(keys)).sum() - 1) < 1e-5


def test_sequences_of_other_texts_change_no_seating(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "one dog and another dog"), (3, None)], "doc_id long, text string")
    some = lm.corpus_counts(docs.where("doc_id <> 2").select("text"))
    every = lm.corpus_counts(docs, lm.F.col("doc_id") != 2)
    assert sorted(map(tuple, every.where("n > 0").collect())) == sorted(map(tuple, some.collect())) and every.where("n = 0").count() > 0
    one = lm.scores(docs, some, lm.train(some)).orderBy("doc_id").collect()
    assert one == lm.scores(docs, every, lm.train(every), counted=True).orderBy("doc_id").collect()


def test_rare_sequences_meet_the_table_in_arrays(spark):
    """Sums by text over packed entries of two slices, with a long text, repeats, large logarithms and sequences that the table lacks."""
    rng = np.random.default_rng(47)
    key = np.unique(rng.integers(0, 1 << 56, 5000).astype(np.uint64))
    log = -rng.integers(1, 20 << 32, len(key))
    values = spark.createDataFrame(pa.table({"key": lm.signed(key), "log": log})).repartition(3)
    rows, want = [], {}
    for first in (0, 1 << 33):
        own = np.append(key[rng.integers(0, len(key), 4000)], np.uint64(7))
        text, times = rng.integers(0, 50, len(own)), rng.integers(1, 1 << 10, len(own))
        text[:3000] = 3
        for k, t, n in zip(own, text, times):
            at = int(np.searchsorted(key, k))
            want[first + int(t)] = want.get(first + int(t), 0) + (int(log[at]) * int(n) if key[at] == k else 0)
        rows += [(first, *r) for r in zip(*(c.to_pylist() for c in lm.dealt(lm.spread(own), own, text, times)))]
    entries = spark.createDataFrame(rows, "row long, g int, keys binary, texts binary, times binary").repartition(4)
    assert {r["row"]: r["score_cold"] for r in lm.summed_logs(entries, values).collect()} == {r: x for r, x in want.items() if x}
    assert lm.summed_logs(entries.limit(0), values).count() == 0


def test_packed_numbers_come_back_and_take_less():
    x = np.sort(np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 1000))
    for n in (0, 1, 1000):
        assert (lm.unpacked(lm.packed(x[:n]), np.int64) == x[:n]).all()
    assert len(lm.packed(np.arange(1000))) < 1000


def test_sums_in_proportion_to_texts(spark, monkeypatch):
    """However many shuffle partitions there are, a text has at most one partial sum in each of a fixed number of tasks."""
    held = []
    monkeypatch.setattr(lm, "cut_arrays", lambda df, name: held.append(df) or df)
    values = spark.createDataFrame([(i, -1) for i in range(1000)], "key long, log long")
    key, text = np.arange(1000, dtype=np.uint64), np.arange(1000) % 7
    rows = [(0, *r) for r in zip(*(c.to_pylist() for c in lm.dealt(lm.spread(key), key, text, np.ones(1000, np.int64))))]
    entries = spark.createDataFrame(rows, "row long, g int, keys binary, texts binary, times binary")
    got = {r["row"]: r["score_cold"] for r in lm.summed_logs(entries, values).collect()}
    assert got == {t: -int((text == t).sum()) for t in range(7)}
    assert "hashpartitioning(g#" in (plan := held[0]._jdf.queryExecution().toString()) and f", {lm.JOINED})" in plan
