import numpy as np
import public_tokenizers
import pytest
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from coldshelf.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def tokenizer():
    return pieces.PieceTokenizer(MODEL, threads=1)


def test_query_equals_sentencepiece(spark):
    texts = dict(rows("documents", "doc_id, text"))
    got = queries.op3_sentencepiece(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.parity and r.round_trip and r.ids == PLAIN.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = pieces.encoded(docs, MODEL).collect()
    assert len(got) == len(ODD_TEXTS) and all(r.parity and r.round_trip for r in got)
    assert sorted(map(str, (r.ids for r in got))) == sorted(str(PLAIN.encode(t or "")) for t in ODD_TEXTS)
    assert pieces.encoded(nothing(docs), MODEL).collect() == []


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("aZ é9.,▁<s>日 \n\t") | st.characters(codec="utf-8", exclude_characters="\0"), max_size=40))
def test_ids_and_texts_equal_sentencepiece(tokenizer, text):
    ids, sizes, same, decoded = tokenizer.encode([text])
    assert ids.tolist() == PLAIN.encode(text) and same.tolist() == decoded.tolist() == [True] and sizes.tolist() == [len(ids)]
    back = tokenizer.decode([ids.tolist()])[0]
    assert back == PLAIN.decode(ids.tolist()) == tokenizer.restored(tokenizer.normalize(text))
    assert tokenizer.normalize(text) == (tokenizer.normalizer.normalize_str(text) if text else "")


def test_unigram_model_is_rebuilt(tmp_path):
    """The pieces of the given model, marked as a unigram model with white space squeezed."""
    proto = pieces.parse(MODEL)
    proto.trainer_spec.model_type = pieces.UNIGRAM
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    plain, mine = SentencePieceProcessor(model_file=str(path)), pieces.PieceTokenizer(str(path), 1)
    for text in ("The quick brown fox", "  two   spaces  ", "über", "日本 🙂", ""):
        ids, _, same, decoded = mine.encode([text])
        assert same.all() and decoded.all()
        assert ids.tolist() == plain.encode(text)
        assert mine.decode([ids.tolist()])[0] == mine.restored(mine.normalize(text))


def test_a_difference_is_reported():
    tokenizer = pieces.PieceTokenizer(MODEL, threads=1)
    encode = tokenizer._plain.encode
    tokenizer._plain = type("Other", (), {"encode": lambda _, parts, **k: [x + [1] if p == "▁odd" else x for p, x in zip(parts, encode(parts))]})()
    for _ in range(2):
        _, _, same, decoded = tokenizer.encode(["an odd one", None, "an even one"])
        assert same.tolist() == [False, True, True] and decoded.all()


def test_a_text_that_does_not_decode_is_reported():
    tokenizer = pieces.PieceTokenizer(MODEL, threads=1)
    encode = tokenizer._encode_parts
    wrong = PLAIN.encode("other")
    tokenizer._memo._encode = lambda parts: [wrong if p == "▁odd" else x for p, x in zip(parts, encode(parts))]
    _, _, same, decoded = tokenizer.encode(["", "an odd one", "an even one"])
    assert same.tolist() == decoded.tolist() == [True, False, True]


def test_a_wrong_normaliser_is_reported(tmp_path):
    """White space at the ends is stripped by the rebuilt normaliser, line ends too; the library keeps line ends."""
    proto = pieces.parse(MODEL)
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "squeezed.model"
    path.write_bytes(proto.SerializeToString())
    plain, mine = SentencePieceProcessor(model_file=str(path)), pieces.PieceTokenizer(str(path), 1)
    texts = ["two  spaces ", "line end\n", "", None, "plain"]
    ids, sizes, same, _ = mine.encode(texts)
    lists = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert same.tolist() == [x == plain.encode(t or "") for x, t in zip(lists, texts)] and same[0]
