"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of ASCII letters and digits and non-ASCII characters.
Documents and benchmark items that share a seed, ``MIN_MATCH`` consecutive
words, are joined on it. For each such pair the longest common stretch of words
is marked in both, then the next longest among what is unmarked, down to
``MIN_MATCH`` words (running Karp-Rabin finds the stretches of a length). The
item's share of marked words is its coverage, whatever the order its stretches
have in the document. Items of fewer than ``MIN_MATCH`` words match nothing.

A hash of the words at every place of a text is computed from running sums, for
all texts of a batch at once. As long as the benchmark's seeds are few enough to
be sent to every task, documents without any are passed over where they are
read; beyond that, all seeds of the documents are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from coldshelf.llm.rolling import powers, stretch_hashes
from coldshelf.llm.shared import each_batch, free_names, slices, written

MIN_MATCH = 5
THRESHOLD = 0.5
#: Seeds (8 bytes each) sent to every task at most.
SENT_SEEDS = 1 << 22
SLICE = 1 << 20

_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> bytes:
    """The text's words with single spaces between them; null is empty."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split())


def seeds_of(lines: list[bytes], length: int = MIN_MATCH) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``length`` consecutive words, and which of the lines of words it lies in."""
    whole = b"\n".join(lines) + b"\n"
    data = np.frombuffer(whole, dtype=np.uint8)
    ends = np.flatnonzero(data <= 32)  # of words
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    line = np.cumsum(np.concatenate([[0], data[ends[:-1]] == 10]))
    if len(ends) < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first, last = slice(0, len(ends) - length + 1), slice(length - 1, None)
    inside = line[first] == line[last]
    return stretch_hashes(data, starts[first][inside], ends[last][inside]), line[first][inside]


def tiles(item: list, text: list, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length) of maximal non-overlapping matches, longest first."""
    codes: dict = {}
    a = np.array([codes.setdefault(w, len(codes) + 1) for w in item], dtype=np.uint64)
    b = np.array([codes.get(w, 0) for w in text], dtype=np.uint64)
    free_a, free_b = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)
    found = []
    for length in range(min(len(a), len(b)), min_match - 1, -1):
        hash_a, hash_b = _rolling(a, length), _rolling(b, length)
        open_a, open_b = _open(free_a, length), _open(free_b, length)
        at_b = np.flatnonzero(open_b & np.isin(hash_b, hash_a[open_a]))
        if not len(at_b):
            continue
        places: dict[int, list[int]] = {}
        for i in np.flatnonzero(open_a).tolist():
            places.setdefault(int(hash_a[i]), []).append(i)
        for j in at_b.tolist():
            if not free_b[j : j + length].all():
                continue
            for i in places[int(hash_b[j])]:
                if free_a[i : i + length].all() and (a[i : i + length] == b[j : j + length]).all():
                    free_a[i : i + length] = free_b[j : j + length] = False
                    found.append((i, j, length))
                    break
    return found


def _rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of each ``length`` consecutive codes."""
    up, down = powers(len(codes) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * up[: len(codes)], dtype=np.uint64)])
    return (sums[length:] - sums[:-length]) * down[: len(codes) - length + 1]


def _open(free: np.ndarray, length: int) -> np.ndarray:
    """Where a stretch of so many unmarked places begins."""
    taken = np.concatenate([[0], np.cumsum(~free)])
    return taken[length:] == taken[:-length]


def coverage(item: str | None, text: str | None) -> tuple[float, int, int]:
    """Share of the item's words that tiles cover, number of tiles, words in the longest."""
    words = words_of(item).split()
    found = tiles(words, words_of(text).split()) if len(words) >= MIN_MATCH else []
    return sum(n for *_, n in found) / max(1, len(words)), len(found), max([0, *(n for *_, n in found)])


def _seed_rows(rows: DataFrame, name: str) -> DataFrame:
    """``(<name>, seed)``, distinct, for ``rows(<name>, text)``."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, line = seeds_of([words_of(t) for t in batch.column("text").to_pylist()])
        return pa.record_batch([batch.column(name).take(pa.array(line)), pa.array(hashes.view(np.int64))], names=[name, "seed"])

    return rows.select(name, "text").mapInArrow(each_batch(make), f"{name} long, seed long").distinct()


def _with_seeds(docs: DataFrame, known: np.ndarray | None) -> DataFrame:
    """``(doc_id, text, seeds)`` of documents that have a known seed; of all that have any, where ``known`` is None."""
    sent = None if known is None else docs.sparkSession.sparkContext.broadcast((known, _first_test(known)))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = [words_of(t) for t in batch.column("text").to_pylist()]
        rows, lists = [], []
        for a, b in slices([len(x) for x in lines], SLICE):
            hashes, line = seeds_of(lines[a:b])
            if sent is not None:
                seeds, first_test = sent.value
                at = np.flatnonzero(first_test[hashes >> np.uint64(44)])
                at = at[np.isin(hashes[at], seeds)]
                hashes, line = hashes[at], line[at]
            cuts = np.flatnonzero(np.diff(line)) + 1
            for part, n in zip(np.split(hashes, cuts), line[np.concatenate([[0], cuts])] if len(line) else []):
                rows.append(a + int(n))
                lists.append(np.unique(part).view(np.int64))
        made = batch.take(pa.array(rows, pa.int64()))
        return made.append_column("seeds", pa.array(lists, pa.list_(pa.int64())))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each_batch(make), "doc_id long, text string, seeds array<long>")


def _first_test(known: np.ndarray) -> np.ndarray:
    """Whether a known seed has these upper 20 bits: a first test that leaves few to look up."""
    made = np.zeros(1 << 20, dtype=bool)
    made[known >> np.uint64(44)] = True
    return made


def contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, item_id, coverage, n_tiles, longest, content)`` of each document and item with enough coverage.

    One row per row of ``documents`` and row of ``benchmark``; ``content`` is
    Spark's ``xxhash64`` of the document's text. Null and empty texts match nothing.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item_text"))
    items = written(spark, items.withColumn("item", F.monotonically_increasing_id()), "benchmark-items")
    seeds = written(spark, _seed_rows(items.select("item", F.col("item_text").alias("text")), "item"), "benchmark-seeds")
    known = None
    if seeds.count() <= SENT_SEEDS:
        known = np.unique(seeds.select("seed").toPandas().seed.to_numpy(dtype=np.int64).view(np.uint64))
    hits = written(spark, _with_seeds(docs, known).withColumn("row", F.monotonically_increasing_id()), "seeded-documents")
    pairs = (
        hits.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select("row", "item").distinct()
    )
    pairs = pairs.join(hits.drop("seeds"), "row").join(items, "item")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [coverage(i, t) for i, t in zip(batch.column("item_text").to_pylist(), batch.column("text").to_pylist())]
        measured = [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.float64(), pa.int64(), pa.int64()))]
        kept = [batch.column(c) for c in ("doc_id", "item_id", "content")]
        return pa.record_batch([*kept, *measured], names=["doc_id", "item_id", "content", "coverage", "n_tiles", "longest"])

    rows = pairs.select("doc_id", "item_id", F.xxhash64("text").alias("content"), "text", "item_text")
    found = rows.mapInArrow(
        each_batch(make), "doc_id long, item_id long, content long, coverage double, n_tiles long, longest long"
    )
    return found.where(F.col("coverage") >= threshold).select("doc_id", "item_id", "coverage", "n_tiles", "longest", "content")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` without those that contain benchmark items, with all their columns."""
    bad = contaminated(spark, docs, benchmark, threshold).select("doc_id", "content").distinct()
    names = bad_id, bad_content = free_names(docs, "bad_id", "bad_content")
    bad = written(spark, bad.toDF(*names), "contaminated")
    same = docs["doc_id"].cast("long").eqNullSafe(bad[bad_id]) & (F.xxhash64(docs["text"].cast("string")) == bad[bad_content])
    return docs.join(bad, same, "left_anti")
