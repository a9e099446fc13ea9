import numpy as np

from fieldnotes.llm import langid


def test_held_out_accuracy(spark):
    from fieldnotes.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    got = QUERIES["op3_bloom_language"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet"), "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and len(held) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98


def test_filter_against_sets(spark, docs_of):
    """The filter finds every n-gram of a language, and its counts are the sets' but for a few false positives."""
    texts = [("en", "the cat sat on the mat"), ("en", "the dog sat on the log"), ("de", "der hund lag auf dem teppich"), ("xx", "zzz zzz")]
    model = langid.learn(docs_of([(i, t, x) for i, (x, t) in enumerate(texts)]))
    assert model.langs == ["de", "en", "xx"]
    sets = {x: {int(g) for y, t in texts if y == x for g in langid.grams(t)} for x in model.langs}
    probe = [langid.grams(t) for t in ("the hund sat", "zzz", "auf the teppich")]
    got = model.counts(np.concatenate(probe), np.cumsum([0, *map(len, probe)]))
    for row, g in zip(got, probe):
        exact = [len(sets[x] & {int(h) for h in g}) for x in model.langs]
        assert all(e <= n <= e + 2 for e, n in zip(exact, row))


def test_grams():
    g = lambda t: {int(x) for x in langid.grams(t)}
    assert g("Ab, c") == g("ab c") == g("  AB 12 c!") and not len(langid.grams("12 !?")) and not len(langid.grams(None))
    long = "ab cde " * 300_000  # several pieces
    assert g(long) == g("ab cde " * 3) | g("ab cde")


def test_more_than_64_languages(spark, docs_of):
    rows = [(i, f"{chr(0x4E00 + i) * 3} {chr(0x5E00 + i)}{chr(0x5F00 + i)}", f"l{i:03d}") for i in range(70)]
    model = langid.learn(docs_of(rows))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs_of(rows), model).collect()}
    assert got == {i: x for i, _, x in rows}


def test_edges(spark, weird, docs_of):
    docs, rows = weird
    got = langid.predict(docs, langid.learn(docs)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3)) and by[10]["lang_pred"] == "ja"
    none = langid.learn(docs_of([]))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs_of([]), none).count() == 0
    # an unknown alphabet: the language with the most documents
    model = langid.learn(docs_of([(1, "abc", "a"), (2, "abd", "b"), (3, "abe", "b")]))
    assert [(r["lang_pred"], r["score"]) for r in langid.predict(docs_of([(1, "щщщщ")]), model).collect()] == [("b", 0.0)]
