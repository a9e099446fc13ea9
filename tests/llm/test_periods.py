import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldnotes.llm import periods

SPACES = {c: " " for c in (9, 10, 11, 12, 13)}


def split(text):
    return [w for w in (text or "").translate(SPACES).split(" ") if w]


def brute(words, least=6, exponent=4):
    """Every stretch of words equal to those q further on, for every q; its smallest period must be q."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                part = words[i : i + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def digest(words):
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def found(texts, *limits):
    code = {}
    codes = [[code.setdefault(w, len(code)) for w in t] for t in texts]
    flat, size = np.array([c for t in codes for c in t], np.int64), np.array([len(t) for t in texts], np.int64)
    out = [[] for _ in texts]
    for t, *r in periods.runs_of(flat, size, *limits).tolist():
        out[t].append(tuple(r))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), max_size=6))
def test_runs_against_brute_force(texts):
    assert found(texts) == [brute(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 5)), max_size=8), st.integers(3, 5))
def test_planted_repeats_against_brute_force(parts, exponent):
    words = [w for p, k, cut in parts for w in (p * k)[cut:]]
    assert found([words, words[1:]], 1, exponent) == [brute(words, 1, exponent), brute(words[1:], 1, exponent)]


def test_repeats_end_at_the_end_of_a_text():
    assert found([["a"] * 5, ["a"] * 5, [], ["a"] * 6, ["b", "a"] * 4]) == [[], [], [], [(0, 6, 1)], [(0, 8, 2)]]


def test_long_and_nested_runs():
    word = ["x", "x", "x", "x", "x", "x", "y"]
    text = word * 500
    runs = found([text])[0]
    assert (0, 3500, 7) in runs and len(runs) == 501
    assert found([["q"] * 100_000])[0] == [(0, 100_000, 1)]


def test_whole_table_against_brute_force(spark, sf_dir):
    rows = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 12_000]
    got = {r.doc_id: tuple(r)[1:] for r in periods.op12_basic_factors(spark, sf_dir).collect()}
    assert len(rows) > 150 and sum(got[r.doc_id][0] > 0 for r in rows) > 10
    for r in rows:
        assert got[r.doc_id] == digest(planted(r.doc_id, r.text)), r.doc_id


def test_defined_cases(spark, weird, docs_of):
    docs, rows = weird
    got = periods.periodic_runs(docs).collect()
    want = []
    for i, text, *_ in rows:
        words = split(text)
        runs = brute(words) if len(words) < 5000 else []
        want.append((i, runs, collapsed(words, runs)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(want, key=key)
    assert periods.periodic_runs(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, min_exponent=2)


def test_words_are_cut_at_six_characters_only(spark, docs_of):
    text = "  a\x1c \x85 \t a\x1c \x85\x0b\x0ca\x1c \x85\r\na\x1c \x85  "
    r = periods.periodic_runs(docs_of([(1, text)])).first()
    assert [tuple(x) for x in r.runs] == [(1, 8, 2)] and r.collapsed == "  a\x1c \x85  "
