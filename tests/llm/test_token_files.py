import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from coldshelf.llm import queries, simple8b, token_files

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def plain(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def expected(documents):
    made, start = [], 0
    for i, text in documents:
        ids = np.array(plain(text), dtype="<u4")
        made.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return made


def test_query_equals_whole_text_encoding(spark):
    got = queries.op4_token_files(spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == expected(sorted(rows("documents", "doc_id, text")))


def test_odd_documents(spark, tmp_path):
    docs = odd_documents(spark)
    token_files.write_token_files(spark, docs, f"file://{tmp_path}/files", VOCABULARY)
    got = sorted(map(tuple, token_files.token_index(spark, f"file://{tmp_path}/files").collect()), key=lambda r: r[1])
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(plain(r.text))
    assert [r[0] for r in got] == [None, 0, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert got[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    back = token_files.read_token_files(spark, f"file://{tmp_path}/files").collect()
    for r in back:
        assert r.ids in want[r.doc_id]
    assert len(back) == len(ODD_TEXTS)


def test_empty_table(spark, tmp_path):
    token_files.write_token_files(spark, nothing(odd_documents(spark)), f"file://{tmp_path}/none", VOCABULARY)
    assert token_files.token_index(spark, f"file://{tmp_path}/none").collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ é9.,'’s \n\t \u0085_-日²") | st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, sizes = token_files.encode_texts(texts, VOCABULARY)
    assert ids.tolist() == [x for t in texts for x in plain(t)]
    assert sizes.tolist() == [len(plain(t)) for t in texts]


def test_different_pieces_with_one_hash_keep_their_own_ids():
    word = "a"
    while len(word) < 4096:  # Thue-Morse: sums of powers modulo 2^64 cannot tell it from its mirror image
        word += word.translate(str.maketrans("ab", "ba"))
    texts = []
    for n in (512, 1024, 2048, 4096):
        for text in (word[:n], word[:n].translate(str.maketrans("ab", "ba"))):
            texts += [text, f"see {text} here", text]
    for _ in range(2):
        ids, sizes = token_files.encode_texts(texts, VOCABULARY)
        assert ids.tolist() == [x for t in texts for x in plain(t)]
        assert sizes.tolist() == [len(plain(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3) | st.integers(0, 70_000) | st.integers(0, 2**64 - 1), max_size=300), max_size=5))
def test_code_round_trip(lists):
    values = np.array([v for x in lists for v in x], dtype=np.uint64)
    coded = simple8b.encode(values, np.array([len(x) for x in lists], dtype=np.int64))
    out, sizes = simple8b.decode(coded)
    assert out.tolist() == values.tolist() and sizes.tolist() == [len(x) for x in lists]
    for one, x in zip(coded, lists):
        assert simple8b.decode([one])[0].tolist() == x


@pytest.mark.parametrize("value,count", [(1, 60), (3, 30), (255, 7), (32767, 4), (2**60 - 1, 1)])
def test_as_many_numbers_as_fit_share_a_word(value, count):
    coded = simple8b.encode(np.full(count, value, dtype=np.uint64), np.array([count]))[0]
    assert np.frombuffer(coded, "<u4", 4).tolist() == [count, 1, 1, 0]
