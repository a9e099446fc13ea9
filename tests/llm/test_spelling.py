import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fieldnotes.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def brute(counts, ratio=5):
    """word -> (form, root, n, n_near, form_n). Candidates share a word with one code point less; ``near`` decides."""
    held = {}
    for w in counts:
        for k in {w, *deletions(w)}:
            held.setdefault(k, []).append(w)
    form, out = {}, {}
    links = {w: {x for k in {w, *deletions(w)} for x in held[k] if near(w, x)} for w in counts}
    for w, others in links.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(links[w]), counts.get(form[w]))
    return out


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def words_with_edits(seed, n, letters, lengths):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list(letters), rng.integers(*lengths))) for _ in range(n)]
    out = Counter()
    for w in base:
        out[w] += int(rng.integers(1, 4000) ** rng.uniform(0.2, 1))
        for _ in range(4):
            i, c = rng.integers(0, len(w) + 1), rng.choice(list(letters))
            w = [w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]][rng.integers(3)] or "a"
            out[w] += int(rng.integers(1, 30))
    return out


@pytest.mark.parametrize("seed, n, letters, lengths, most", [
    (1, 150, "ab", (1, 9), spelling.BLOCK), (2, 150, "ab", (1, 9), 40), (3, 150, "abcdé", (5, 14), 1), (4, 200, "aéÿ𝔘", (2, 7), 100),
])
def test_against_brute_force(spark, seed, n, letters, lengths, most):
    """Dense lists of short words, with blocks that are cut down to single code points and blocks that are not cut."""
    counts = words_with_edits(seed, n, letters, lengths)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(words, most=most)) == brute(counts)


def test_a_common_beginning_and_a_common_end(spark):
    """Many words with one beginning or one end: their blocks are cut, and every pair is still found once."""
    rng = np.random.default_rng(7)
    part = {"".join(rng.choice(list("abc"), 5)) for _ in range(150)}
    counts = {w: int(n) for w, n in zip({"preprepre" + p for p in part} | {p + "ationally" for p in part}, rng.integers(1, 999, 999))}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(words, most=200, least=6)) == brute(counts)
    cut = spelling.blocks(words, 6, 200)
    assert cut.groupBy(*spelling.BLOCK_COLUMNS).count().where("count * (a + 1) > 200 AND j - i > 1 AND count > 2").count() == 0


def test_chains_ties_and_repeated_rows(spark):
    rows = [("aaaaaa", 1), ("aaaaab", 5), ("aaaabb", 20), ("aaaabb", 5), ("aaabbb", 125), ("caaaab", 5), ("zzzzzz", 4), ("zzzzzy", 20), ("zzzzzx", 20), (None, 9), ("", 3), ("zzzzzzzz", 1)]
    out = got(spelling.variants(spark.createDataFrame(rows, "word string, n long")))
    assert out["aaaaaa"] == ("aaaaab", "aaabbb", 1, 1, 5)
    assert out["aaaaab"] == ("aaaabb", "aaabbb", 5, 3, 25)
    assert out["zzzzzz"] == ("zzzzzx", "zzzzzx", 4, 2, 20) and out["zzzzzzzz"] == (None, "zzzzzzzz", 1, 0, None)
    assert None not in out and "" not in out
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_long_words(spark):
    long = "ab" * 3000
    counts = {long: 100, long[:-1]: 3, long[:2000] + "x" + long[2000:]: 2, long[:4000] + "y" + long[4001:]: 1, "c" + long: 5}
    assert got(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute(counts)


def vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def test_whole_table_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(vocabulary(rows))
    assert got(spelling.op11_sorted_variants(spark, d)) == want
    assert len(want) > 1000 and sum(x[0] is not None for x in want.values()) > 20


def test_defined_cases(spark, weird, docs_of, tmp_path):
    docs, rows = weird
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert got(spelling.op11_sorted_variants(spark, str(tmp_path))) == brute(vocabulary([r[:2] for r in rows]))
    assert spelling.letter_runs(docs_of([])).count() == 0
    runs = spelling.letter_runs(docs_of([(1, "ÀÉabcD éééééé×÷ abcde x-ABCDEFG\nhijklm"), (2, None), (None, "É")]), 2)
    assert sorted(r.run for r in runs.collect()) == sorted(["ÀÉabcd", "éééééé×÷", "abcde", "abcdefg", "hijklm"])
