from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fieldnotes.llm import templates as t
from tests.llm.helpers import prose

ITEM = ("John Smith buys 12 apples and 5 pears for 30 dollars at the old market near the river. He gives 5 pears to his friend Mary. "
        "How many apples does he have left if he sells 12 apples for 2 dollars each to the people of the town?")


def verdicts(spark, docs_of, items, texts):
    found = {r["k"]: r["items"] for r in t.contaminated(docs_of(list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string")).collect()}
    keyed = {r["text"]: r["k"] for r in t.keyed(docs_of(list(enumerate(texts)))).collect()}
    return [found.get(keyed.get(x), []) for x in texts]


def test_changed_questions(spark, docs_of):
    rng = np.random.default_rng(6)
    pad = prose(rng, 40)
    changed = (ITEM.replace("12", "77").replace("5 pears", "9 pears").replace("John Smith", "Peter").replace("Mary", "Karen"))
    torn = ITEM.replace("gives 5", "gives 8").replace("sells 12", "sells 99").replace("for 2 dollars", "for 12 dollars").replace("30 dollars", "12 dollars")
    texts = [f"{pad}. {ITEM} {pad}", f"{pad}. {changed} {pad}", f"{pad}. {torn} {pad}", f"{pad}. {ITEM.lower()} {pad}", pad,
             " ".join(ITEM.split()[:14]) + " " + pad, pad + " " + " ".join(ITEM.split()[10:]), " ".join(sorted(ITEM.split())), ITEM.replace(" ", "  \n")]
    got = verdicts(spark, docs_of, [(1, ITEM), (2, prose(rng, 50)), (3, None), (4, "too short")], texts)
    #       as it is, consistent slots, broken slots, lower case, nothing, a third of it, most of it, its words sorted
    assert got[:8] == [[1], [1], [], [1], [], [], [1], []]


UNIT_WORDS = set(t.UNITS)


def own_tokens(text):
    """Two readings of a text as lists of (kind, value), character by character; nothing of the operator's code is used."""
    tokens = []  # [kind, value, starts a sentence]
    starts = True
    for word in text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" "):
        if not word:
            continue
        i, first = 0, True
        while i < len(word):
            letter = lambda j: j < len(word) and word[j].isalnum() and not word[j].isdecimal()
            digit = lambda j: j < len(word) and "0" <= word[j] <= "9"
            j = i
            if digit(i) or (word[i] in "$€£" and digit(i + 1)):
                j += not digit(i)
                while digit(j):
                    j += 1
                while j < len(word) and word[j] in ".,:/" and digit(j + 1):
                    j += 1
                    while digit(j):
                        j += 1
                j += j < len(word) and word[j] == "%"
                tokens.append(["number", word[i:j].lower(), False])
            elif letter(i):
                while letter(j):
                    j += 1
                while j < len(word) and word[j] in "'’-" and letter(j + 1):
                    j += 1
                    while letter(j):
                        j += 1
                part = word[i:j]
                kind = "number" if not part[0].isalpha() else "unit" if part.lower() in UNIT_WORDS else "name" if part[0].isupper() and part[1:].islower() else "literal"
                tokens.append([kind, part.lower(), first and starts])
            else:
                i += 1
                continue
            first = False
            i = j
        closed = word
        while closed and closed[-1] in "\"')]»”’":
            closed = closed[:-1]
        starts = word[-1] in ".!?" or (closed != word and closed[-1:] in (".", "!", "?"))
    inside = {v for k, v, begins in tokens if k == "name" and not begins}
    for i, x in enumerate(tokens):
        if x[0] == "unit" and (i == 0 or tokens[i - 1][0] != "number"):
            x[0] = "literal"
    readings = []
    for names in (False, True):
        out = []
        for kind, value, begins in tokens:
            if kind == "name" and begins and value not in inside and not names:
                kind = "literal"
            if kind == "name" and out and out[-1][0] == "name":
                out[-1] = ("name", out[-1][1] + (value,))
            else:
                out.append((kind, (value,)))
        readings.append(out)
    return readings


def brute(docs, items):
    """(doc_id, item_id) by the definition, with loops."""

    def shape(window):
        return tuple(v if k == "literal" else k for k, v in window)

    out = set()
    known = []
    for item_id, text in items:
        for reading, item in enumerate(own_tokens(text or "")):
            if len(item) >= t.MIN_TOKENS:
                width = min(t.WINDOW, len(item))
                windows = [item[i : i + width] for i in range(len(item) - width + 1)]
                use = [i for i, w in enumerate(windows) if sum(k == "literal" for k, _ in w) >= min(t.LITERALS, width)] or list(range(len(windows)))
                known.append((item_id, reading, width, windows, use))
    for doc_id, text in docs:
        for reading, doc in enumerate(own_tokens(text or "")):
            at = {}
            for width in {x[2] for x in known}:
                for i in range(len(doc) - width + 1):
                    at.setdefault((width, shape(doc[i : i + width])), []).append(i)
            for item_id, r, width, windows, use in known:
                lines = {}
                for j in use if r == reading else ():
                    for i in at.get((width, shape(windows[j])), ()):
                        lines.setdefault(i - j, []).append((i, j))
                covered = set()
                for hits in lines.values():
                    pairs = {(a[1], b[1]) for i, j in hits for a, b in zip(windows[j], doc[i : i + width]) if a[0] != "literal"}
                    clashes = 2 * len(pairs) - len({x for x, _ in pairs}) - len({y for _, y in pairs})
                    if clashes <= t.CONFLICTS * len(pairs):
                        covered |= {j for _, j in hits}
                if len(covered) >= t.COVERAGE * len(use):
                    out.add((doc_id, item_id))
    return out


TOM = "Tom has 5 apples. Tom buys 3 more apples. How many apples does Tom have?"


def test_names_that_begin_sentences(spark, docs_of):
    """A changed name at the start of every sentence, and a name that stands nowhere else, is a slot."""
    rng = np.random.default_rng(16)
    pad = prose(rng, 40)
    once = "Karen sells 12 red apples and 7 green pears at the market for 30 dollars a day. Then she counts the money in her bag."
    texts = [f"{pad}. {TOM} {pad}", f"{pad}. {TOM.replace('Tom', 'Anna').replace('5', '9')} {pad}", f"{pad} {TOM.replace('Tom', 'Anna')}",
             f"{pad}. {once.replace('Karen', 'Peter')} {pad}", f"{pad}. {once.replace('Karen', 'Peter Miller').replace('12', '99')} {pad}",
             f"{pad}. {TOM.replace('apples', 'of the pears')} {pad}"]
    assert verdicts(spark, docs_of, [(1, TOM), (2, once)], texts) == [[1], [1], [1], [2], [2], []]


def test_wrapping_changes_nothing(spark, docs_of):
    """A passage with a line feed before any of its words, or before all of them, matches as before."""
    rng = np.random.default_rng(26)
    pad, words = prose(rng, 30), ITEM.split(" ")
    texts = [f"{pad}\n" + " ".join(words[:i]) + "\n" + " ".join(words[i:]) + f"\n{pad}" for i in range(1, len(words))]
    texts += [pad + "\n" + "\n".join(words), pad + " " + ITEM]
    assert verdicts(spark, docs_of, [(1, ITEM)], texts) == [[1]] * len(texts)
    kind = lambda text: [k.tolist() for _, k, _ in t.Tokens().of([text])]
    assert all(kind("\n".join(words[:i]) + "\n" + " ".join(words[i:])) == kind(ITEM) for i in range(1, len(words)))


def test_windows_that_many_items_and_texts_hold(spark, docs_of):
    """Items that share most of their windows are told apart by the rest, without pairing every item with every text."""
    rng = np.random.default_rng(36)
    shared = "the farmer from the old village takes 12 apples to the market near the river and sells them there"
    tails = [prose(rng, 30, 2000) for _ in range(25)]
    items = [(i, f"{shared} {x}") for i, x in enumerate(tails)]
    texts = [f"{shared} {prose(rng, 40, 2000)}" for _ in range(40)] + [f"{shared.replace('12', '40')} {x}" for x in tails[:5]]
    assert verdicts(spark, docs_of, items, texts) == [[]] * 40 + [[i] for i in range(5)]
    docs = t.keyed(docs_of(list(enumerate(texts))))
    known = t.item_windows(t.benchmark(spark.createDataFrame(items, "item_id long, text string"))).select("*", F.xxhash64("item_id").alias("item")).withColumnRenamed("at", "item_at")
    found = t.text_windows(docs, t.key_filter(known.select("w").distinct()), [t.WINDOW], None)
    assert t.candidates(found, known).select("k", "item").distinct().count() == 5 < len(items) * len(texts)


def test_columns_named_as_the_helpers(spark, docs_of):
    docs = docs_of([(1, TOM), (2, "a clean text of some words")]).withColumn("bad", F.lit("mine")).withColumn("_bad", F.lit(1))
    items = spark.createDataFrame([(1, TOM)], "item_id long, text string")
    assert [(r.doc_id, r.bad, r._bad) for r in t.drop_contaminated(docs, items).collect()] == [(2, "mine", 1)]


def test_against_brute_force(spark, sf_dir):
    from fieldnotes.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op5_template_windows"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and {(r["doc_id"], i) for r in rows for i in r["items"]} == brute(docs, items) != set()
    assert all(r["contaminated"] == bool(r["items"]) for r in rows)
    # every passage that stands in a document word for word is found
    plain = {(d, i) for d, text in docs for i, item in items if item in text}
    assert plain <= brute(docs, items)


def test_tokens():
    names = "literal number unit name".split()
    show = lambda texts: [[(int(a), names[k]) for a, k in zip(text, kind)] for text, kind, _ in t.Tokens().of(texts)]
    literal, name = show(["Mr Bean ran 5kg, 3 km. The man", "", "Jane saw Paris. Paris saw"])
    rest = [(0, "literal"), (0, "number"), (0, "unit"), (0, "number"), (0, "unit")]
    # the second Paris begins a sentence and stands inside the one before: a name, which joins the run
    more = [(2, "literal"), (2, "literal"), (2, "name"), (2, "literal")]
    assert literal == [(0, "literal"), (0, "name"), *rest, (0, "literal"), (0, "literal"), *more]
    assert name == [(0, "name"), *rest, (0, "name"), (0, "literal"), (2, "name"), *more[1:]]
    again = t.Tokens()
    joined = again.of(["a b c", "A b c d"])[0]
    assert Counter(joined[0].tolist()) == {0: 3, 1: 4} and joined[2][0] == joined[2][3]


def test_edges(spark, weird, docs_of):
    docs, rows = weird
    items = spark.createDataFrame([(1, rows[3][1]), (None, rows[8][1]), (7, "")], "item_id long, text string")
    kept = t.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "6", "9", "10", "11", "12", "None"])
    none = spark.createDataFrame([], "item_id long, text string")
    assert t.drop_contaminated(docs, none).count() == len(rows) and t.drop_contaminated(docs_of([]), items).count() == 0
