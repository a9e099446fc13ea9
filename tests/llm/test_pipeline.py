from collections import Counter

import duckdb
import zstandard

import corpus_pipeline
from fieldnotes.llm import mixing, quality
from tests.llm.test_lines import brute_drop
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_templates import brute as brute_contaminated


def test_stages_against_brute_force(spark, sf_dir):
    """The whole pipeline on the small tables, each stage by its brute-force version."""
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    source = {i: s for i, _, s in docs}
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    rows = [(i, t) for i, t, _ in docs if quality.passes(t, packer)]
    assert 0 < len(rows) < len(docs)
    rows = brute_drop(rows)
    group = brute_components([i for i, _ in rows], [brute_fingerprint(t) for _, t in rows])
    rows = [r for r, g in zip(rows, group) if r[0] == g]
    bad = {i for i, _ in brute_contaminated(rows, items)}
    rows = [r for r in rows if r[0] not in bad]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, source[i]) for i, t in rows])
    text = dict(rows)
    want = {(r[0], text[r[0]], r[1], r[2], r[3], r[4]) for r in con.sql(mixing.sql()).fetchall() if r[4]}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["text"], r["size"], r["source_size"], r["target"], r["taken"]) for r in got) == Counter(want)
    assert all(r["source"] == source[r["doc_id"]] for r in got)


def test_stages_keep_columns_and_take_edges(spark, weird, docs_of, sf_dir):
    docs, rows = weird
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "source_mix"]
    for table in (docs, docs_of([])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == table.columns and out.count() <= len(rows)
        corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).count()
