import codecs
import hashlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldnotes.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.model_of(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
codecs.register_error("one by one", pieces.one_by_one)

ODD = ["", " ", "  a", "a  ", "\n", "日本語 x\x00y", "▁a ▁", "a" * 5000, "<s></s><0x0A>", "é️👩‍👩‍👧 ok", "\r\n\r\n();\r", "�", " " * 50 + "x" + " " * 33,
       "　x\xa0y", "ab" * 200 + " " + "-=" * 100, "ÀÉß, naïve!", "٣٤٥ ௧௨", "á é", "𝔘𝔫𝔦"]


def number(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(k, value):
    return number(8 * k) + number(value) if isinstance(value, int) else number(8 * k + 2) + number(len(value)) + value


def with_rules(rule, **flags):
    """The model with another normaliser, as the library compiles it."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule, **flags).serialized_normalizer_spec()
    data = Path(PATH).read_bytes()
    return b"".join(field(k, v) for k, v in pieces.message(data) if k != 3) + field(3, spec)


def encoded(model, texts):
    many, *columns = model.encode(texts)
    cuts = np.cumsum(many)[:-1]
    return [list(zip(*(x.tolist() for x in three))) for three in zip(*(np.split(c, cuts) for c in columns))]


def library_pieces(library, text):
    return [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


def agree(model, library, texts):
    for text, got in zip(texts, encoded(model, texts)):
        ids = [i for i, _, _ in got]
        assert got == library_pieces(library, text), text
        assert model.decode(ids) == library.decode(ids), text


def test_pieces_spans_and_texts_as_the_library():
    agree(MODEL, LIBRARY, ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text("ab ▁é\n.,1"), st.text("the and of, \n", min_size=60, max_size=200)), max_size=5))
def test_any_text_as_the_library(texts):
    agree(MODEL, LIBRARY, texts)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("extra", [True, False])
def test_compiled_character_maps_as_the_library(rule, extra):
    """Longest prefixes: composed, folded and widened characters, with and without the removal of extra spaces."""
    data = with_rules(rule, add_dummy_prefix=True, remove_extra_whitespaces=extra, escape_whitespaces=True)
    model, library = pieces.Model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    agree(model, library, [*ODD, "  ＡＢ  ½ Ⅳ ", "ｶﾞｷﾞ ﷺ ㌔ éé̂ Å ﬁﬃ", "\t a   b​", "각 각ᆨ", "İSTANBUL ẞ ΑΣ", " ", "   ", "ﷺ ﷺ"])


@settings(max_examples=150, deadline=None)
@given(st.text("eEａＡ́̂ 　½ﬁ각e\t\n각 ", max_size=30))
def test_any_composition_as_the_library(text):
    data = FOLDED[0]
    agree(FOLDED[1], FOLDED[2], [text, data and text * 2])


FOLDED = (True, *(f(with_rules("nmt_nfkc_cf", add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True))
                  for f in (pieces.Model, lambda d: sentencepiece.SentencePieceProcessor(model_proto=d))))


@given(st.lists(st.integers(0, 31999), max_size=30))
def test_any_ids_decode_as_the_library(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_bytes_that_are_no_text():
    at = MODEL.bytes_at
    for ids in ([at[0xE6], at[0x97]], [at[0xE6], 300, at[0x80]], [at[0xF0], at[0x9F], at[0x98], at[0x80], at[0xFF]], [1, 2, 0], [0, 1], [at[32], 260]):
        assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 3)
    model = pieces.Model(Path(PATH).read_bytes())
    for part in (ODD[:6], ODD[6:], ODD):
        agree(model, LIBRARY, part)


def test_other_models_are_refused():
    data = Path(PATH).read_bytes()
    changed = [*pieces.message(data)]
    user = dict(pieces.message(changed[300][1])) | {3: pieces.USER_DEFINED}
    for model in (b"".join(field(k, v) for k, v in changed if k != 2),
                  b"".join(field(k, v if i != 300 else field(1, user[1]) + field(3, user[3])) for i, (k, v) in enumerate(changed))):
        with pytest.raises(ValueError):
            pieces.Model(model)


def digests(texts):
    ids = [LIBRARY.encode(t or "") for t in texts]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return [(len(i), sha(",".join(map(str, i))), sha(LIBRARY.decode(i)), len((t or "").encode())) for i, t in zip(ids, texts)]


def test_whole_table_as_the_library(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, *d) for r, d in zip(rows, digests([r.text for r in rows])))
    got = pieces.op13_offset_pieces(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes").collect()
    assert sorted(map(tuple, got)) == want


def test_defined_cases(spark, weird, docs_of):
    docs, rows = weird
    got = pieces.with_decoded(pieces.encode(docs, MODEL), MODEL).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.decoded) for r in got), key=key) == sorted(((i, t or "") for i, t, *_ in rows), key=key)
    assert all(len(r.ids) == len(r.starts) == len(r.ends) for r in got)
    assert pieces.encode(docs_of([]), MODEL).count() == 0
    null = spark.createDataFrame([(None, "x")], "ids array<int>, key string")
    assert [tuple(r) for r in pieces.with_decoded(null, MODEL).collect()] == [(None, "x", "")]
    with pytest.raises(ValueError):
        pieces.with_decoded(null, MODEL, name="key")


def test_null_and_empty_texts_have_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = pieces.op13_offset_pieces(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes").collect()
    assert sorted(map(tuple, got)) == [(i, *d) for (i, _), d in zip(rows, digests([t for _, t in rows]))]


def test_texts_decoded_together_are_those_decoded_alone():
    """Ids of many texts at once, with empty ones, bytes that are no text and space symbols at the front."""
    codecs.register_error("one by one", pieces.one_by_one)
    rng = np.random.default_rng(17)
    lists = [[], [MODEL.bytes_at[0xE2]], [MODEL.ids["▁"]] * 3, *(rng.integers(0, len(MODEL.pieces), n).tolist() for n in (1, 5, 0, 40)), []]
    got = MODEL.decode_all(np.array([i for x in lists for i in x]), np.append(0, np.cumsum([len(x) for x in lists])))
    assert got == [MODEL.decode(x) for x in lists] and got[:3] == ["", "�", LIBRARY.decode(lists[2])]
