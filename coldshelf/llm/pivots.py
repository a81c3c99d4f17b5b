"""Exact top-k search by inner product, with candidates eliminated through a pivot table.

Vectors are whole numbers: floor(256 * x) of each component. Appending
sqrt(M^2 - |x|^2) to each vector x (M, the largest norm) and 0 to each query
makes the largest inner product the smallest Euclidean distance:
d^2 = |q|^2 + M^2 - 2 q.x. The distances of all vectors to a few pivots are
computed once and kept with them. By the triangle inequality the largest
|d(q, p) - d(x, p)| over the pivots bounds d(q, x) from below, so q.x from
above. Candidates are evaluated in the order of their bounds, in exact whole
numbers, until the next bound lies below the k-th best score: what is left
cannot enter the answer, ties included.

Vectors and queries are packed in blocks of bounded size, and each pair of
blocks is one row of work, so no task holds more than one pair at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from coldshelf.llm.shared import written

PIVOTS = 16
#: Pivots are chosen among so many vectors; the choice changes the speed and no result.
PIVOT_SAMPLE = 1024
VECTOR_BLOCK = 4096
QUERY_BLOCK = 256
#: Candidates evaluated at a time, in the order of their bounds.
STEP = 256
#: Squares of norms from which a vector has no bound, as its products pass the exact whole numbers of a float.
LARGE = 2.0**52


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vec)``: floor(256 * x) of each component; vectors that are null or have null or non-finite parts are left out."""
    parts = F.col("embedding").cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.col("embedding").isNotNull() & finite)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(parts, lambda x: F.floor(x * 256)).alias("vec")
    )


def _augmented(vecs: np.ndarray, norm2: float) -> np.ndarray:
    vecs = vecs.astype(np.float64)
    rest = np.sqrt(np.maximum(0.0, norm2 - (vecs * vecs).sum(axis=1)))
    return np.concatenate([vecs, rest[:, None]], axis=1)


def _distances(vecs: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vecs * vecs).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * vecs @ pivots.T
    return np.sqrt(np.maximum(0.0, squares))


def choose_pivots(sample: np.ndarray, norm2: float, count: int = PIVOTS) -> np.ndarray:
    """Vectors of the sample that lie far from one another, one after the other; as augmented vectors."""
    points = _augmented(sample, norm2)
    chosen = [0]
    nearest = _distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vecs: np.ndarray, table: np.ndarray,
    pivots: np.ndarray, norm2: float, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best of one block of vectors: query id, vec_ids, scores."""
    points = np.concatenate([queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1)
    large = (vecs.astype(np.float64) ** 2).sum(axis=1) >= LARGE
    to_pivots = _distances(points, pivots)
    squares = (points * points).sum(axis=1)
    # Rounding errors of the distances are far below this share of the scale.
    slack = 1e-6 * (norm2 + squares.max(initial=0.0, where=squares < LARGE)) + 1e-3
    for q, query in enumerate(queries):
        lower = np.abs(table - to_pivots[q]).max(axis=1)
        bound = (squares[q] + norm2 - lower * lower) / 2 + slack
        bound[large | (squares[q] >= LARGE)] = np.inf  # always evaluated
        bound[ids == query_ids[q]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        best_ids, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for i in range(0, len(order), STEP):
            near = order[i : i + STEP]
            near = near[bound[near] > -np.inf]
            if not len(near) or (len(best_ids) == k and bound[near[0]] < best_scores[-1]):
                break
            best_ids = np.concatenate([best_ids, ids[near]])
            best_scores = np.concatenate([best_scores, vecs[near] @ query])
            keep = _best(best_scores, best_ids, k)
            best_ids, best_scores = best_ids[keep], best_scores[keep]
        yield int(query_ids[q]), best_ids, best_scores


def _packed(rows: DataFrame, size: int, blocks: int) -> DataFrame:
    """Rows ``(vec_id, vec)`` dealt over numbered blocks and packed: ``(block, dim, ids, vecs)``.

    A row has at most ``size`` vectors, all of one dimension; a block may have several rows.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows[rows.vec.map(len) > 0]
            for (block, dim), group in rows.groupby([rows.block, rows.vec.map(len)]):
                for i in range(0, len(group), size):
                    part = group.iloc[i : i + size]
                    ids, vecs = part.vec_id.to_numpy("<i8"), np.stack(part.vec.to_numpy()).astype("<i8")
                    yield pd.DataFrame({"block": [block], "dim": [dim], "ids": [ids.tobytes()], "vecs": [vecs.tobytes()]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.repartition(blocks, "block").mapInPandas(pack, "block int, dim int, ids binary, vecs binary")


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k vectors of largest inner product for each query.

    Both tables are ``(vec_id, embedding)``. A vector is no candidate for the
    query of its own vec_id, nor for queries of another length. Ties go to the
    smaller vec_id. A query that occurs twice is answered once. Vectors with a
    null vec_id take no part. Very large vectors, whose bounds could not be
    computed exactly, are always evaluated; an error is raised only where an inner
    product may not fit 64 bits.
    """
    vecs = written(spark, whole_vectors(vectors).where("vec_id IS NOT NULL"), "whole-vectors")
    asked = whole_vectors(queries).where("vec_id IS NOT NULL").dropDuplicates(["vec_id"])
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usual = F.max(F.when(norm < LARGE, norm))
    total, norm2, largest = vecs.agg(F.count(F.lit(1)), usual, F.max(norm)).first()
    if (largest or 0.0) * (asked.agg(F.max(norm)).first()[0] or 0.0) >= 2.0**126:
        raise ValueError("inner products of these vectors may not fit 64 bits")
    norm2 = float(norm2 or 0.0)
    sample = vecs.where(norm < LARGE).orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).toPandas()
    pivots = {
        int(d): choose_pivots(np.stack(g.vec.to_numpy()), norm2) for d, g in sample.groupby(sample.vec.map(len)) if d
    }

    def pivots_of(dim: int) -> np.ndarray:
        """The origin is the pivot of a length that the sample misses."""
        return pivots.get(dim, np.zeros((1, dim + 1)))

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the distances of a block's vectors to the pivots."""
        for batch in batches:
            made = []
            for dim, block in zip(batch.column("dim").to_pylist(), batch.column("vecs").to_pylist()):
                points = _augmented(np.frombuffer(block, "<i8").reshape(-1, dim), norm2)
                made.append(_distances(points, pivots_of(dim)).astype("<f8").tobytes())
            yield batch.append_column("pivot_table", pa.array(made, pa.binary()))

    def blocks(count: int, size: int) -> int:
        return max(1, -(-count // size))

    packed = _packed(vecs, VECTOR_BLOCK, blocks(total, VECTOR_BLOCK))
    packed = packed.mapInArrow(tables, "block int, dim int, ids binary, vecs binary, pivot_table binary")
    packed = written(spark, packed.drop("block"), "pivot-table")
    query_blocks = blocks(asked.count(), QUERY_BLOCK)
    asked = _packed(asked, QUERY_BLOCK, query_blocks).toDF("q_block", "q_dim", "q_ids", "q_vecs")
    asked = written(spark, asked, "query-blocks")
    # Every block of vectors meets every block of queries: a list of block numbers, then a join on the number.
    numbers = F.sequence(F.lit(0), F.lit(query_blocks - 1))
    pairs = packed.withColumn("q_block", F.explode(numbers)).join(asked, "q_block").where("dim = q_dim")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                found = search_block(
                    np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_vecs"], "<i8").reshape(-1, dim),
                    np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vecs"], "<i8").reshape(-1, dim),
                    np.frombuffer(row["pivot_table"], "<f8").reshape(-1, len(pivots_of(dim))),
                    pivots_of(dim), norm2, k,
                )
                made = [(q, i, s) for q, ids, scores in found for i, s in zip(ids.tolist(), scores.tolist())]
                yield pa.record_batch(
                    [pa.array([m[j] for m in made], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"]
                )

    best = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
