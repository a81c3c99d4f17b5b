"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages; labels are known for documents only. Every
passage is encoded (h = tanh(W x + b) of its character features), gated
attention gives it a weight (softmax over the document of w . (tanh(V h) *
sigmoid(U h))), and the weighted sum of its passages' codes is what a logistic
unit scores (Ilse et al., "Attention-based Deep Multiple Instance Learning",
2018). So a document is judged by the passages that tell, wherever they stand.

Features of passages are computed by Spark. The weights are fitted on the
driver, on a bounded sample of labelled documents; scoring covers all passages
of all documents.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from coldshelf.llm.shared import each_batch, slices

#: Characters in a passage, about: a text is cut into equal passages.
PASSAGE_CHARS = 1000
#: The sample that the model is fitted on: so many labelled documents at most, chosen by a hash of doc_id, of at most
#: so many characters each (longer ones are passed over) and so many passages in all, which is some 100 MB.
TRAIN_DOCS = 4000
TRAIN_CHARS = 200_000
TRAIN_PASSAGES = 100_000
PREDICT_AT = 0.7
BATCH_DOCS = 64
#: In a passage of so many characters, features count half.
TRUST_CHARS = 30
SEED = 7

CLASSES, PAIRS = 64, 192
FEATURES = CLASSES + PAIRS + 3
SLICE = 1 << 19

# Characters with a class of their own, beside the letters a to z.
_OWN = " \n.,!?|#$%&*=+-_/\\:;\"'()[]{}<>@"


@cache
def _classes() -> np.ndarray:
    """The class of each code point: its letter, other small, capital, digit, one of ``_OWN``, or other."""
    made = np.full(0x110000, 30, dtype=np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            made[code] = 27 if c.isupper() else 26
        elif c.isdigit():
            made[code] = 28
        elif c.isspace():
            made[code] = 29
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        made[ord(c)] = i
    for i, c in enumerate(_OWN):
        made[ord(c)] = 31 + i
    return made


@cache
def _pair_buckets() -> np.ndarray:
    """The feature of each pair of classes."""
    return (np.arange(CLASSES * CLASSES) * 40503 % 65521 % PAIRS).astype(np.uint8)


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and how many each text has (an empty text: one)."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    n_passages = np.maximum(1, np.rint(lengths / PASSAGE_CHARS).astype(np.int64))
    total = int(n_passages.sum())
    nth = np.arange(total) - np.repeat(np.cumsum(n_passages) - n_passages, n_passages)
    length, parts = np.repeat(lengths, n_passages), np.repeat(n_passages, n_passages)
    sizes = (nth + 1) * length // parts - nth * length // parts
    passage = np.repeat(np.arange(total, dtype=np.int32), sizes)

    kind = _classes()[codes].astype(np.int32)
    single = np.bincount(passage * CLASSES + kind, minlength=total * CLASSES).reshape(total, CLASSES)
    pair = passage * PAIRS
    pair[:-1] += _pair_buckets()[kind[:-1] * CLASSES + kind[1:]]
    inner = np.ones(len(codes), dtype=bool)
    inner[np.cumsum(sizes)[sizes > 0] - 1] = False  # a passage's last character begins no pair
    double = np.bincount(pair[inner], minlength=total * PAIRS).reshape(total, PAIRS)
    words, repeated = _words(codes, kind, passage, total)
    scale = 1 / np.maximum(sizes, 1)[:, None]
    rest = np.stack([repeated / np.maximum(words, 1), words / np.maximum(sizes, 1), np.log1p(sizes) / 7], axis=1)
    return np.concatenate([np.sqrt(single * scale), np.sqrt(double * scale), rest], axis=1).astype(np.float32), n_passages


def _words(codes: np.ndarray, kind: np.ndarray, passage: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Words in each passage, and those that only repeat the word before."""
    gap = (kind == 29) | (kind == 31) | (kind == 32)
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = gap[:-1] | (passage[1:] != passage[:-1])
    at = np.flatnonzero(~gap & fresh)
    if not len(at):
        return np.zeros(total), np.zeros(total)
    # A word's value: its characters, each multiplied by an odd number that tells its place in the word.
    place = np.arange(at[0], len(codes), dtype=np.uint32) - np.repeat(at.astype(np.uint32), np.diff(np.append(at, len(codes))))
    value = np.where(gap, np.uint32(0), codes + np.uint32(1))[at[0] :]
    value = value * np.uint32(2654435761)
    value = (value ^ (value >> np.uint32(15))) * (place * np.uint32(40502) + np.uint32(1))
    word = np.add.reduceat(value, at - at[0])
    same = np.concatenate([[False], (word[1:] == word[:-1]) & (passage[at[1:]] == passage[at[:-1]])])
    return np.bincount(passage[at], minlength=total), np.bincount(passage[at[same]], minlength=total)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]  # W, b, V, U, w, c, d
    constant: float | None = None  # the score of all documents, where there was nothing to tell apart


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(x: np.ndarray, sizes: np.ndarray, weights: tuple) -> tuple:
    """Attention of each passage and score of each document, with what their gradients need."""
    encode, bias, tanh_gate, sigmoid_gate, attend, judge, offset = weights
    starts = np.cumsum(sizes) - sizes
    code = np.tanh(x @ encode + bias)
    left, right = np.tanh(code @ tanh_gate), _sigmoid(code @ sigmoid_gate)
    raw = (left * right) @ attend
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), sizes))
    share = raw / np.repeat(np.add.reduceat(raw, starts), sizes)
    bag = np.add.reduceat(code * share[:, None], starts, axis=0)
    return code, left, right, share, bag, _sigmoid(bag @ judge + offset)


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features as deviations from the training mean, which count for less in short passages: their shares are chance."""
    chars = np.expm1(7 * x[:, -1:])
    return (x - mean) * scale * (chars / (chars + TRUST_CHARS))


def score(x: np.ndarray, sizes: np.ndarray, model: Model) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(sizes), model.constant)
    return _forward(_scaled(x, model.mean, model.scale), sizes, model.weights)[-1]


def _gradients(x: np.ndarray, sizes: np.ndarray, weights: tuple, labels: np.ndarray, cost: np.ndarray) -> list[np.ndarray]:
    encode, bias, tanh_gate, sigmoid_gate, attend, judge, offset = weights
    code, left, right, share, bag, probability = _forward(x, sizes, weights)
    error = (probability - labels) * cost / len(sizes)
    d_bag = np.repeat(error[:, None] * judge, sizes, axis=0)
    d_share = (d_bag * code).sum(axis=1)
    starts = np.cumsum(sizes) - sizes
    d_raw = share * (d_share - np.repeat(np.add.reduceat(share * d_share, starts), sizes))
    d_left = d_raw[:, None] * attend * right * (1 - left * left)
    d_right = d_raw[:, None] * attend * left * right * (1 - right)
    d_code = d_bag * share[:, None] + d_left @ tanh_gate.T + d_right @ sigmoid_gate.T
    d_in = d_code * (1 - code * code)
    return [
        x.T @ d_in, d_in.sum(axis=0), code.T @ d_left, code.T @ d_right, (left * right).T @ d_raw, bag.T @ error, error.sum(keepdims=True)
    ]


def fit(bags: list[np.ndarray], labels: np.ndarray, codes: int = 32, gates: int = 16, epochs: int = 25, steps: int = 1000) -> Model:
    """A model of documents given as passage features, by Adam over batches.

    Documents of label 0, if they are the fewer, weigh more, by the root of how much fewer they are.
    It takes ``epochs`` rounds over the documents, or as many more as make up ``steps`` batches.
    """
    labels = np.asarray(labels, dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(0), np.zeros(0), (), float(labels[0]) if len(labels) else 1.0)
    stacked = np.concatenate(bags)
    mean, scale = stacked.mean(axis=0), 1 / (stacked.std(axis=0) + 0.02)
    bags = [_scaled(b, mean, scale) for b in bags]
    rng = np.random.default_rng(SEED)
    shapes = [(FEATURES, codes), (codes,), (codes, gates), (codes, gates), (gates,), (codes,), (1,)]
    weights = [rng.normal(0, 1 / np.sqrt(s[0]), s) if i not in (1, 6) else np.zeros(s) for i, s in enumerate(shapes)]
    weights = [w.astype(np.float32) for w in weights]
    share = labels.mean()
    cost = np.where(labels == 1, 1.0, np.sqrt(share / (1 - share)).clip(1))
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    epochs, step = max(epochs, -(-steps * BATCH_DOCS // len(bags))), 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH_DOCS):
            some = order[i : i + BATCH_DOCS]
            sizes = np.array([len(bags[j]) for j in some])
            gradient = _gradients(np.concatenate([bags[j] for j in some]), sizes, tuple(weights), labels[some], cost[some])
            step += 1
            for k, g in enumerate(gradient):
                g = g + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                change = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                weights[k] = (weights[k] - change).astype(np.float32)
    return Model(mean, scale, tuple(weights))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on documents that ``labels(doc_id, <label>)`` marks 0 or 1, a bounded sample of them.

    The bounds are ``TRAIN_DOCS``, ``TRAIN_CHARS`` and ``TRAIN_PASSAGES``. Of
    several labels for a doc_id the smallest counts, of several texts the one
    of smallest hash; null ids and labels do not count. The same tables give the
    same model, whatever the order of their rows.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("double").alias("mark"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.coalesce(F.length("text"), F.lit(0)) <= TRAIN_CHARS)
    # At most TRAIN_DOCS rows of two numbers, here and below.
    rows = texts.join(F.broadcast(chosen), "doc_id").withColumn("content", F.xxhash64("text"))
    passages_of = (F.ceil(F.coalesce(F.length("text"), F.lit(0)) / PASSAGE_CHARS) + 1).alias("n")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("content", passages_of)).alias("one")).select("doc_id", "one.*")
    so_far = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    one = one.withColumn("so_far", so_far).where(F.col("so_far") <= TRAIN_PASSAGES).select("doc_id", "content")
    rows = rows.join(F.broadcast(one), ["doc_id", "content"])

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = [passages([t or ""])[0].tobytes() for t in batch.column("text").to_pylist()]
        columns = [batch.column("doc_id"), batch.column("mark"), pa.array(bags, pa.binary())]
        return pa.record_batch(columns, names=["doc_id", "mark", "bag"])

    rows = rows.select("doc_id", "text", "mark").mapInArrow(each_batch(make), "doc_id long, mark double, bag binary")
    # Rows of one id are equal by now.
    rows = rows.groupBy("doc_id").agg(F.min("mark").alias("mark"), F.min("bag").alias("bag"))
    found = sorted((r.doc_id, bytes(r.bag), r.mark) for r in rows.collect())
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES) for _, b, _ in found]
    return fit(bags, np.array([m for *_, m in found]))


def scores_of(texts: list[str | None], model: Model) -> np.ndarray:
    """Quality of each text, 0 to 1; null is empty."""
    texts = [t or "" for t in texts]
    made = [np.zeros(0)]
    for a, b in slices([len(t) for t in texts], SLICE):
        made.append(score(*passages(texts[a:b]), model))
    return np.concatenate(made)


def scored(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, predicted)`` for each row of ``documents``."""
    sent = spark.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scores_of(batch.column("text").to_pylist(), sent.value)
        predicted = pa.array((found >= PREDICT_AT).astype(np.int32))
        return pa.record_batch([batch.column("doc_id"), pa.array(found), predicted], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each_batch(make), "doc_id long, score double, predicted int")


def good(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` whose text is predicted to be of quality, with all their columns."""
    sent = spark.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = scores_of(batch.column("text").to_pylist(), sent.value) >= PREDICT_AT
        return batch.filter(pa.array(keep))

    return docs.mapInArrow(each_batch(make), docs.schema)
