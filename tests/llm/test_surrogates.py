import re

from fieldnotes.llm import surrogates as s

TEXT = ("Mr. John Smith (john.smith@mail.example.com, +1 (743) 555-3824) met Mary Jones. Later SMITH called 743-555-3824 from 192.168.10.7; "
        "card 4111 1111 1111 1111, SSN 123-45-6789. token = \"24be64439e3e49cf46b2d7c90f36aa11\" password: 'hunter2x!' Мария Иванова. ")


def replaced(spark, docs_of, rows):
    return {r["doc_id"]: r for r in s.replace(docs_of(rows)).collect()}


def test_types_and_formats(spark, docs_of):
    out = replaced(spark, docs_of, [(1, TEXT)])[1]
    text = out["text"]
    assert out["n_entities"] == 15 and out["kinds"] == ["card", "email", "family", "given", "ip", "phone", "secret", "ssn"]
    for known in ("John", "Smith", "SMITH", "john.smith@mail.example.com", "555-3824", "192.168.10.7", "4111 1111", "123-45-6789", "24be6443", "hunter2x", "Иванова"):
        assert known not in text
    phones = re.findall(r"\+1 \((\d{3})\) (\d{3}-\d{4})|(?<=called )(\d{3})-(\d{3}-\d{4})", text)
    assert len(phones) == 2 and phones[0][0] + phones[0][1] == phones[1][2] + phones[1][3]  # one entity, two formats
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4})", text)[1].replace(" ", "")
    assert s.luhn(card) and card[0] == "4"
    first, family = re.match(r"Mr\. (\w+) (\w+)", text).groups()
    assert family.upper() + " called" in text and first[0].isupper()
    assert re.search(r"[А-Я][а-я]+(?:а|ья|ия) [А-Я][а-я]+\. $", text)  # script and gender
    assert re.search(r'token = "[0-9a-f]{32}"', text)


def test_coreference_and_distinctness_over_documents(spark, docs_of):
    rows = [(i, f"write to user{i % 50}@corp{i % 7}.com or call (2{i % 90:02d}) 555-{i % 90:04d}") for i in range(400)]
    out = replaced(spark, docs_of, rows)
    mails, phones = {}, {}
    for i, t in rows:
        mails.setdefault(t.split()[2], set()).add(out[i]["text"].split()[2])
        phones.setdefault(t.split("call ")[1], set()).add(out[i]["text"].split("call ")[1])
    for seen in (mails, phones):
        assert all(len(x) == 1 for x in seen.values())
        assert len({next(iter(x)) for x in seen.values()}) == len(seen) and not set(seen) & {next(iter(x)) for x in seen.values()}


def test_collisions_draw_again(spark):
    """Eight one-digit telephone numbers have few surrogates: all end up distinct, and none is a real one."""
    known = spark.createDataFrame([("phone", x) for x in ("0", "1", "2", "3")], "kind string, canonical string")
    rows = s.attempts(known, b"key").collect()
    made = {r["surrogate"] for r in rows}
    assert len(made) == 4 and not made & {"0", "1", "2", "3"} and any(r["attempt"] for r in rows)
    assert all(s.surrogate(b"key", r["kind"], r["canonical"], r["attempt"]) == r["surrogate"] for r in rows)


def test_redrawn_entities_reach_the_texts(spark, docs_of, monkeypatch):
    real = s.surrogate
    monkeypatch.setattr(s, "surrogate", lambda key, kind, canonical, attempt=0: "same@x.org" if kind == "email" and not attempt else real(key, kind, canonical, attempt))
    out = replaced(spark, docs_of, [(1, "a@b.org and c@d.org"), (2, "c@d.org"), (3, "nothing"), (4, None)])
    one, other = out[1]["text"].split(" and ")
    assert one == "same@x.org" and other == out[2]["text"] != one and out[3]["text"] == "nothing" and out[4]["text"] is None


def test_clean_text_and_edges(spark, weird, docs_of):
    docs, rows = weird
    got = s.replace(docs).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(str, (r[:2] for r in rows)))  # nothing to replace
    clean = "Version 1.2.3 of 2001-10-15 costs 10 20 30 dollars; The Big Apple, page 1234567."
    assert s.mentions(clean) == []
    assert s.replace(docs_of([])).count() == 0


def test_whole_table(spark, sf_dir):
    from fieldnotes.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op4_surrogates"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = s.mentions(docs[r["doc_id"]])
        assert r["n_entities"] == len(found) and (found or r["text"] == docs[r["doc_id"]])
        real = [docs[r["doc_id"]][a:b] for a, b, _, _ in found]
        assert not any(x in r["text"] for x in real)


def test_names_by_their_place():
    """Names that no list holds, told by what stands around them; the same words without it are left alone."""
    text = ("Dear Tomasz,\nplease ask Ruth Levi (ruth@x.org) or Ada Okafor <ada@x.org>. Contact: Yuki Tanaka\nMy name is Olu Bello and Tomasz knows.\n"
            "Sincerely,\nJane Doe\nJane will call, and TANAKA too.")
    names = [text[a:b] for a, b, k, _ in s.mentions(text) if k.startswith(("given", "family"))]
    assert names == ["Tomasz", "Ruth", "Levi", "Ada", "Okafor", "Yuki", "Tanaka", "Olu", "Bello", "Tomasz", "Jane", "Doe", "Jane", "TANAKA"]
    for clean in ("Tomasz met Ruth Levi and Yuki Tanaka.", "Dear Customer, Hello World. Thanks,\nThe Team", "The Big Apple (1998) and Blue River (see page 3)", "a name: none, contact: us"):
        assert s.mentions(clean) == [], clean
    assert [k for _, _, k, _ in s.mentions("Dear Anna, dear Bob Stone:")] == ["given f LATIN"]


def test_long_and_mixed_hexadecimal_and_cases(spark, docs_of):
    long, mixed = "0a1b" * 100, "aB3dE6fA90Cd" * 4
    rows = [(1, f"key {long} and {mixed}"), (2, "Write to Bob.Stone@Mail.com, BOB.STONE@MAIL.COM or bob.stone@mail.com")]
    out = replaced(spark, docs_of, rows)
    _, new_long, _, new_mixed = out[1]["text"].split(" ")
    assert out[1]["n_entities"] == 2 and re.fullmatch("[0-9a-f]{400}", new_long) and new_long != long
    assert [c.isupper() for c in new_mixed] == [c.isupper() for c in mixed] and [c.isdigit() for c in new_mixed] == [c.isdigit() for c in mixed] and new_mixed != mixed
    one, two, three = re.findall(r"\S+@[\w.]+\w", out[2]["text"])
    assert one == three[0].upper() + three[1:] and two == three.upper() and three.islower() and len({one, two, three}) == 3


PLAIN = {"email": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}", "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.-]|\.\d)", "hex": r"(?<!\w)[0-9a-f]{32,}(?!\w)"}


def test_whole_table_against_plain_patterns(spark):
    """By patterns of its own: each address, IP and long hexadecimal number goes, equal ones alike over all documents, different ones
    to different ones; the text around all of them stays, but for other entities."""
    from fieldnotes.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = {r["doc_id"]: r["text"] for r in QUERIES["op4_surrogates"](spark, sf_dir).collect()}
    for kind, pattern in PLAIN.items():
        to, back = {}, {}
        for i, text in docs.items():
            old, new = re.findall(pattern, text or ""), re.findall(pattern, out[i] or "")
            assert len(old) == len(new), (kind, i)
            for a, b in zip(old, new):
                assert a != b and to.setdefault(a.lower() if kind == "email" else a, b) == b and back.setdefault(b, a.lower() if kind == "email" else a)
                assert back[b] == (a.lower() if kind == "email" else a)
        assert len(to) > 3 and not set(to) & set(back), kind
    same = [i for i in docs if docs[i] and not re.search(r"\d{2}|@|password|secret|token|api|[A-Z][a-z]+ [A-Z]", docs[i])]
    assert same and all(out[i] == docs[i] for i in same)
