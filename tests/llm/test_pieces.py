from __future__ import annotations

import pytest
from helpers import by_id, documents, frame

from tillflow.llm import pieces
from tillflow.llm.tokenizers import tokenizer_model

spm = pytest.importorskip("sentencepiece")
TEXTS = [
    "", " ", "  ", "a", "a ", " a", "a  ", "Hello  wörld\n\t x", "x▁y", "▁", "\n", "日本語 テキスト 😀 ﬁ", "\0x",
    "é" * 5, " " * 50 + "x", "ab" * 40_000, "the of and " * 3000, "1234 5,6", "\r\n\x0b end", None, "a",
]


@pytest.fixture(scope="module")
def model():
    return tokenizer_model()


def test_ids_and_text_are_the_librarys(spark, model):
    library = spm.SentencePieceProcessor(model_proto=model)
    found = by_id(pieces.decode(pieces.encode(documents(spark, *TEXTS), model), model))
    for i, text in enumerate(TEXTS):
        assert found[i]["ids"] == library.encode(text or "")
        assert found[i]["decoded"] == library.decode(library.encode(text or ""))


def test_spans_cover_the_source(spark, model):
    for i, row in by_id(pieces.encode(documents(spark, *TEXTS), model)).items():
        data = (TEXTS[i] or "").encode()
        assert b"".join(data[b:e] for b, e in zip(row["begins"], row["ends"], strict=True)) == data
        assert all(b <= e for b, e in zip(row["begins"], row["ends"], strict=True))


def test_words_and_whole_texts_agree(model):
    own = pieces.Pieces(model)
    assert own.by_word
    texts = [t for t in TEXTS if t]
    for (ids, span), text in zip(zip(*own.encode(texts), strict=True), texts, strict=True):
        other_ids, other = own._whole(text)
        assert ids.tolist() == other_ids.tolist() and span.tolist() == other.tolist()


def test_few_words_are_kept(model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 3)
    own = pieces.Pieces(model)
    for _ in range(2):
        assert [x.tolist() for x in own.encode(["a b c d e", "f g a"])[0]] == own.library.encode(["a b c d e", "f g a"])
    assert len(own.places) <= 3


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_normalisation_by_a_compiled_map(tmp_path, rule, squeeze):
    """Against the library's own normaliser, with the maps it comes with."""
    library = spm.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    proto = spm.sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto())
    spec = proto.normalizer_spec
    own = pieces.Normaliser(spec)
    for text in [t for t in TEXTS if t is not None and len(t) < 1000] + ["ｶﾞ ㍿ Å ½", "  ﬁ  ", "ＡＢＣ"]:
        normal, source = own.normalise(text)
        assert normal.decode() == library.normalize(text)
        assert len(source) == len(normal) + 1 and source == sorted(source)


def test_clashing_columns_and_no_rows(spark, model):
    docs = frame(spark, [(1, "a b", "x", 3)], "doc_id bigint, text string, ids string, decoded int")
    found = pieces.decode(pieces.encode(docs, model), model)
    assert found.columns == ["doc_id", "text", "ids", "begins", "ends", "decoded"]
    assert found.collect()[0]["decoded"] == "a b"
    assert pieces.encode(docs.limit(0), model).collect() == []
