import re

import pytest
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows
from test_decontaminate import plain_contaminated
from test_pieces import PLAIN
from test_pii import plain as plain_spans

import corpus_pipeline
from coldshelf.llm import simhash
from coldshelf.llm.queries import quality_model, table
from coldshelf.llm.quality import scores_of


def plain_first_copies(docs):
    """One document of each group: the exact share of common distinct five-word shingles, over all pairs."""
    sets = []
    for _, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x20\x09-\x0d]+", lowered)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(docs)))

    def first(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((first(i), first(j)), key=lambda k: docs[k][0])
                group[b] = a
    return [d for i, d in enumerate(docs) if first(i) == i]


def test_run_equals_stages_done_plainly(spark):
    docs = rows("documents", "doc_id, text")
    frame = table(spark, SF_DIR, "documents")
    model = quality_model(spark, frame, SF_DIR)
    docs = [d for d, s in zip(docs, scores_of([t for _, t in docs], model)) if s >= 0.7]
    docs = plain_first_copies(docs)
    bad = {d for d, *_ in plain_contaminated(docs, rows("benchmark", "item_id, text"))}
    docs = {i: t for i, t in docs if i not in bad}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(got) == set(docs) and bad
    for i, text in docs.items():
        back = PLAIN.decode(got[i].ids)
        assert got[i].parity and got[i].round_trip and plain_spans(back) == []
        if not plain_spans(text):
            assert back == text


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_documents(spark, name, stage):
    docs = odd_documents(spark)
    out = stage(spark, docs, SF_DIR)
    assert out.count() <= len(ODD_TEXTS)
    if name != "sentencepiece":
        assert out.columns == docs.columns
    assert stage(spark, nothing(docs), SF_DIR).collect() == []


def test_one_row_of_each_group_stays(spark):
    texts = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, None), (None, ""), (None, "x y"), (None, "x y"), (5, "p q r"), (5, "s t u")]
    docs = spark.createDataFrame([(*t, k) for k, t in enumerate(texts)], "doc_id long, text string, kept_n int")
    got = simhash.keep_one(spark, docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, "a b c"), (3, None), (None, "x y"), (5, "p q r"), (5, "s t u")], key=str)
