import numpy as np
import pytest
from helpers import SF_DIR, nothing, rows

from coldshelf.llm import pivots, queries


def plain(vectors, queries_, k):
    made = []
    for q, query in queries_:
        scores = [(-sum(a * b for a, b in zip(query, v)), i) for i, v in vectors if i != q and len(v) == len(query)]
        made += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(made)


def whole(vectors):
    return [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors]


def test_query_equals_all_scores(spark):
    vectors = whole(rows("embeddings", "vec_id, embedding"))
    got = sorted(map(tuple, queries.op8_pivot_search(spark, SF_DIR).collect()))
    assert got == plain(vectors, [v for v in vectors if v[0] % 50 == 0], 5)


def test_odd_vectors_and_small_blocks(spark, monkeypatch):
    for name, value in (("VECTOR_BLOCK", 16), ("QUERY_BLOCK", 4), ("STEP", 8), ("PIVOT_SAMPLE", 8)):
        monkeypatch.setattr(pivots, name, value)
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    good += [(i, [0.5, 0.25, -1.0, 2.0, 0.0, 0.0]) for i in range(100, 140)]  # ties
    good += [(7, [1.0] * 6), (200, [3.0] * 4), (201, [2.0] * 4), (202, [-100.0] * 6)]
    bad = [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [])]
    frame = spark.createDataFrame([(*r, "x") for r in good + bad + [(None, [1.0] * 6)]], "vec_id long, embedding array<double>, score string")
    asked = frame.where("vec_id IN (0, 5, 100, 139, 200, 202, 300, 303, 304)")
    got = sorted(map(tuple, pivots.top_k(spark, frame, asked, 5).collect()))
    vectors = whole(good)
    assert got == plain(vectors, [v for v in vectors if v[0] in (0, 5, 100, 139, 200, 202)], 5)


def test_very_large_vectors(spark, monkeypatch):
    for name, value in (("VECTOR_BLOCK", 16), ("QUERY_BLOCK", 4), ("STEP", 4), ("PIVOT_SAMPLE", 8)):
        monkeypatch.setattr(pivots, name, value)
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=5).tolist()) for i in range(80)]
    good += [(200 + i, (rng.normal(size=5) * 10.0 ** (i % 4 + 3)).tolist()) for i in range(20)]
    frame = spark.createDataFrame(good, "vec_id long, embedding array<double>")
    asked = frame.where("vec_id % 10 = 3")
    got = sorted(map(tuple, pivots.top_k(spark, frame, asked, 5).collect()))
    vectors = whole(good)
    assert got == plain(vectors, [v for v in vectors if v[0] % 10 == 3], 5)
    with pytest.raises(ValueError, match="64 bits"):
        pivots.top_k(spark, *[spark.createDataFrame([(i, [1e8, 1e8]) for i in range(3)], frame.schema)] * 2)


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert pivots.top_k(spark, nothing(frame), nothing(frame)).collect() == []
    assert pivots.top_k(spark, frame, frame).collect() == []


def test_far_candidates_are_not_evaluated():
    rng = np.random.default_rng(1)
    vecs = np.concatenate([rng.integers(900, 1000, (50, 8)), rng.integers(-1000, -900, (4000, 8))])
    norm2 = float((vecs * vecs).sum(axis=1).max())
    chosen = pivots.choose_pivots(vecs[::7], norm2)
    table = pivots._distances(pivots._augmented(vecs, norm2), chosen)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, i):
            seen.append(len(np.atleast_1d(i)))
            return np.asarray(self)[i]

    out = list(pivots.search_block(np.array([-1]), vecs[:1], np.arange(len(vecs)), vecs.view(Counted), table, chosen, norm2, 5))
    assert len(out[0][1]) == 5 and sum(seen) < len(vecs) / 4
