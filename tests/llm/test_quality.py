import zlib

import numpy as np
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows

from coldshelf.llm import quality, queries


def test_held_out_documents(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in queries.op5_quality(spark, sf_dir).collect()}
    import duckdb

    labels = dict(duckdb.connect().execute(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall())
    held = [(got[i], q) for i, q in labels.items() if got[i].held_out]
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == r.held_out for i, r in got.items())
    assert held and np.mean([r.predicted == q for r, q in held]) > 0.93
    assert np.mean([r.predicted for r, q in held if q == 1]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)]
    sizes, labels, cost = np.array([1, 3, 2]), np.array([1.0, 0.0, 1.0]), np.array([0.5, 1.0, 0.7])
    x = np.concatenate(bags)
    shapes = [(quality.FEATURES, 4), (4,), (4, 3), (4, 3), (3,), (4,), (1,)]
    weights = tuple(rng.normal(0, 0.3, s) for s in shapes)

    def loss(w):
        p = quality._forward(x, sizes, w)[-1]
        return -(cost * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).mean()

    for k, g in enumerate(quality._gradients(x, sizes, weights, labels, cost)):
        at = tuple(rng.integers(0, n) for n in weights[k].shape)
        moved = [w.copy() for w in weights]
        moved[k][at] += 1e-5
        up = loss(tuple(moved))
        moved[k][at] -= 2e-5
        assert abs((up - loss(tuple(moved))) / 2e-5 - g[at]) < 1e-6


def plain_score(text, model):
    """Passage by passage and number by number: encode, gate, weigh by softmax, judge the weighted sum."""
    import math

    encode, bias, tanh_gate, sigmoid_gate, attend, judge, offset = (w.tolist() for w in model.weights)
    codes, raws = [], []
    for x in quality.passages([text or ""])[0].astype(float):
        chars = math.expm1(7 * x[-1])
        x = [(a - m) * s * chars / (chars + quality.TRUST_CHARS) for a, m, s in zip(x, model.mean.tolist(), model.scale.tolist())]
        code = [math.tanh(sum(a * row[j] for a, row in zip(x, encode)) + b) for j, b in enumerate(bias)]
        left = [math.tanh(sum(c * row[j] for c, row in zip(code, tanh_gate))) for j in range(len(attend))]
        right = [1 / (1 + math.exp(-sum(c * row[j] for c, row in zip(code, sigmoid_gate)))) for j in range(len(attend))]
        codes.append(code)
        raws.append(sum(a * b * w for a, b, w in zip(left, right, attend)))
    shares = [math.exp(r - max(raws)) for r in raws]
    bag = [sum(s * c[j] for s, c in zip(shares, codes)) / sum(shares) for j in range(len(judge))]
    return 1 / (1 + math.exp(-sum(b * w for b, w in zip(bag, judge)) - offset[0]))


def test_query_equals_a_plain_attention_loop(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    model = queries.quality_model(spark, docs, SF_DIR)
    got = {r.doc_id: r.score for r in queries.op5_quality(spark, SF_DIR).collect()}
    texts = dict(rows("documents", "doc_id, text"))
    assert set(got) == set(texts)
    for i in sorted(texts, key=lambda i: len(texts[i] or ""))[::7]:
        assert abs(got[i] - plain_score(texts[i], model)) < 1e-4


def test_repeated_ids_and_the_order_of_rows_do_not_change_the_model(spark, monkeypatch):
    docs = [(i, text) for i, text in rows("documents", "doc_id, text")]
    docs += [(i, f"{text} and more") for i, text in docs[:50]] + docs[:20] * 3
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    models = []
    for order in (docs, docs[::-1]):
        frame = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        models.append(quality.train(frame, labels))
    assert all((a == b).all() for a, b in zip(models[0].weights, models[1].weights))


def test_the_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, marks: seen.append((len(bags), sum(map(len, bags)))))
    docs = spark.createDataFrame([(i, "some words " * (50 * i)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    quality.train(docs, labels)
    monkeypatch.setattr(quality, "TRAIN_PASSAGES", 100)
    quality.train(docs, labels)
    monkeypatch.setattr(quality, "TRAIN_DOCS", 3)
    quality.train(docs, labels)
    assert seen[0][0] == 40 and seen[1][1] <= 100 and 0 < seen[1][0] < 40 and seen[2][0] <= 3


def test_attention_finds_the_one_bad_passage():
    good = "A plain sentence of quiet words goes on and on. " * 100
    bad = good[:2000] + "!!! $$$ ||| " * 100 + good[2000:]
    rng = np.random.default_rng(1)
    texts = [good[i : i + 4000 - 10 * i] for i in rng.integers(0, 50, 40)] + [bad[i : i + 5000] for i in rng.integers(0, 50, 40)]
    model = quality.fit([quality.passages([t])[0] for t in texts], np.array([1] * 40 + [0] * 40))
    assert quality.scores_of([good, bad], model).round().tolist() == [1, 0]


def test_whole_texts_count_and_slices_do_not(monkeypatch):
    texts = ["", "one", "word " * 900, "Ü" * 1499 + "!", "same same same " * 70, "x"]
    whole, counts = quality.passages(texts)
    assert counts.tolist() == [1, 1, 4, 2, 1, 1] and whole.shape == (10, quality.FEATURES)
    assert np.allclose(whole, np.concatenate([quality.passages([t])[0] for t in texts]))
    assert whole[-2, -3] > 0.9 and whole[1, -3] == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, 1, 0), (6, None, 0), (None, 1, 1), (10, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = quality.scored(spark, docs, model).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in got)
    kept = quality.good(spark, docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in got)
    assert quality.scored(spark, nothing(docs), model).collect() == []
    assert {r.score for r in quality.scored(spark, docs, quality.train(docs, nothing(labels))).collect()} == {1.0}
