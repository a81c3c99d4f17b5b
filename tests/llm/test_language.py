import numpy as np
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows

from coldshelf.llm import langid, queries


def test_held_out_languages(spark):
    langs = dict(rows("documents", "doc_id, lang"))
    got = queries.op1_language(spark, SF_DIR).collect()
    assert {r.doc_id for r in got} == set(langs) and len(got) == len(langs)
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95
    assert all(0 < r.score <= 1 for r in got)


def plain_score(text, training):
    """Naive Bayes over the same buckets, with a dictionary and a loop."""

    def buckets(t):
        orders, begins, lengths = langid._ngrams([t])
        return [int(b) for o in orders for b in o[begins[0] : begins[0] + lengths[0]]]

    sums = {}
    for lang in sorted({x for _, x in training}):
        counts = {}
        mine = [t for t, x in training if x == lang]
        for b in (b for t in mine for b in buckets(t)):
            counts[b] = counts.get(b, 0) + 1
        total = sum(counts.values()) + langid.SMOOTHING * langid.BUCKETS
        sums[lang] = np.log(len(mine) / len(training)) + sum(
            np.log((counts.get(b, 0) + langid.SMOOTHING) / total) for b in buckets(text)
        )
    best = max(sums, key=sums.get)
    return best, 1 / sum(np.exp(s - sums[best]) for s in sums.values())


def test_scores_equal_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(langid, "SLICE", 40)
    training = [("the cat and the dog", "en"), ("a house of the", "en"), ("el gato y la casa", "es"), ("Übel über der Straße", "de"), ("", "es"), ("", "de")]
    model = langid.train(spark.createDataFrame(training + [(None, "fr"), ("x", None)], "text string, lang string"))
    assert model.languages == ["de", "en", "es"]
    texts = ["the gato", "Straße", "a", "dog dog dog casa", "z" * 100]
    best, sure = langid.score(texts, model)
    for text, b, s in zip(texts, best, sure):
        lang, probability = plain_score(text, training)
        assert model.languages[b] == lang and abs(s - probability) < 1e-9


def test_odd_documents(spark):
    docs = odd_documents(spark)
    model = langid.train(docs.select("text", "lang"))
    got = langid.detect(spark, docs, model).collect()
    assert len(got) == len(ODD_TEXTS)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (0, 1, 2, 5)} == {("und", 0.0)}
    assert langid.detect(spark, nothing(docs), model).collect() == []
    untaught = langid.train(nothing(docs).select("text", "lang"))
    assert {r.lang_pred for r in langid.detect(spark, docs, untaught).collect()} == {"und"}
