import duckdb

from fieldnotes.llm import mixing


def by_sql(docs):
    con = duckdb.connect()
    frame = docs.select("doc_id", "text", "source").toArrow()
    con.register("documents", frame)
    return sorted(con.sql(mixing.sql()).fetchall(), key=str)


def by_spark(docs):
    return sorted((tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def test_edges_against_sql(spark, weird, docs_of):
    docs, rows = weird
    got = by_spark(docs)
    assert got == by_sql(docs) and len(got) == len(rows)
    assert [r[1] for r in got if r[0] in (1, 2, 3)] == [0, 0, 0]
    assert by_spark(docs_of([])) == [] == by_sql(docs_of([]))
    silent = docs_of([(1, None, "en", "a"), (2, "", "en", "b")])
    assert by_spark(silent) == by_sql(silent) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_shares_and_caps(spark, docs_of):
    sizes = {"a": 400, "b": 5000, "c": 5000, None: 30}
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en", s) for s, n in sizes.items() for i in range(n // 5)]
    docs = docs_of([(i, *r[1:]) for i, r in enumerate(rows)])
    got = mixing.mix(docs).collect()
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        x = by.setdefault(r["source"], dict(size=r["source_size"], target=r["target"], taken=0))
        x["taken"] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    assert by["a"]["target"] == 3 * by["a"]["size"] and by[None]["target"] == 3 * by[None]["size"]  # stopped, the excess goes on
    assert abs(by["b"]["target"] - 2 * by["c"]["target"]) < 1e-6 and abs(sum(x["target"] for x in by.values()) - total) < 1e-6
    assert all(abs(x["taken"] - x["target"]) <= 20 for x in by.values()) and sum(x["taken"] for x in by.values()) <= total
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))  # reruns agree


def test_take(spark, weird):
    docs, _ = weird
    out = mixing.take(docs)
    rows = out.collect()
    assert out.columns == [c for c in docs.columns if c not in ("size", "target")] + ["size", "source_size", "target", "copies", "taken"]
    assert rows and all(r["copies"] > 0 and r["taken"] == r["copies"] * r["size"] for r in rows if r["size"])
    assert {r["doc_id"] for r in rows if r["size"]} <= {r["doc_id"] for r in mixing.mix(docs).where("taken > 0").collect()}


def test_columns_named_as_the_helpers(spark, docs_of):
    docs = docs_of([(i, "some words of a text " * (1 + i % 3), "en", "ab"[i % 2]) for i in range(8)])
    names = ("mix_doc_id", "_mix_id", "mix_source", "_mix_source", "mix_size", "_mix_size")
    plain = mixing.take(docs)
    out = mixing.take(docs.selectExpr("*", *(f"'mine' AS {n}" for n in names)))
    assert [c for c in out.columns if c not in names] == plain.columns
    assert sorted((r.doc_id, r.copies) for r in out.collect()) == sorted((r.doc_id, r.copies) for r in plain.collect()) != []
    assert all(r[n] == "mine" for r in out.collect() for n in names)
