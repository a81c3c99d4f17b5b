"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters with everything else a space; runs of
one to three folded characters are hashed into ``BUCKETS``. Counts are summed by
Spark over all training rows; only the matrix of log-probabilities (languages x
buckets, so bounded) reaches the driver and is broadcast. Scoring gathers the
matrix's entries at the n-grams that occur and sums them by text, a batch of
texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from coldshelf.llm.shared import each_batch, slices, small

ORDERS = 3
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: More languages than this would make the matrix too large to broadcast; they are refused.
MAX_LANGUAGES = 256
UNKNOWN = "und"
SLICE = 1 << 19

_SPACE = 32
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


class Model(NamedTuple):
    languages: list[str]
    log_probs: np.ndarray  # languages x buckets
    log_priors: np.ndarray


@cache
def _fold() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    made = np.full(0x110000, _SPACE, dtype=np.uint32)
    for code in range(0x110000):
        if (c := chr(code)).isalpha():
            made[code] = ord(c.lower()[0])
    return made


def _ngrams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the bucket of the n-gram that begins at each place; and each text's first place and length."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    whole = "  ".join(texts) + "   "
    codes = _fold()[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    begins = np.cumsum(lengths + 2) - lengths - 2
    n = len(codes) - ORDERS + 1
    hashed = np.zeros(n, dtype=np.uint32)
    orders = []
    for k in range(ORDERS):
        hashed = hashed * np.uint32(31) + (codes[k : k + n] + np.uint32(k)) * _MULTIPLIERS[k]
        orders.append((hashed ^ (hashed >> np.uint32(15))) * _MULTIPLIERS[0] >> np.uint32(16))
    return orders, begins, lengths


def count_ngrams(rows: DataFrame) -> DataFrame:
    """``(lang, bucket, n)`` over all rows of ``(text, lang)``; bucket -1 counts the rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in small(batches):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for a, b in slices([len(t) for t in texts], SLICE):
                orders, begins, lengths = _ngrams(texts[a:b])
                for lang in sorted(set(langs[a:b])):
                    mine = np.array([x == lang for x in langs[a:b]])
                    at = np.repeat(begins[mine], lengths[mine])
                    at = at + np.arange(len(at)) - np.repeat(np.cumsum(lengths[mine]) - lengths[mine], lengths[mine])
                    counts = totals.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
                    for buckets in orders:
                        counts[:-1] += np.bincount(buckets[at], minlength=BUCKETS)
                    counts[-1] += int(mine.sum())
        for lang, counts in totals.items():
            found = np.flatnonzero(counts)
            bucket = np.where(found == BUCKETS, -1, found)
            yield pa.record_batch(
                [pa.array([lang] * len(found)), pa.array(bucket), pa.array(counts[found])], names=["lang", "bucket", "n"]
            )

    found = rows.mapInArrow(count, "lang string, bucket long, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(rows: DataFrame) -> Model:
    """A model of all rows ``(text, lang)`` whose text and lang are not null. Without rows it knows no language."""
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    languages = [r.lang for r in rows.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = count_ngrams(rows).toPandas()
    counts = np.zeros((len(languages), BUCKETS + 1))
    row = found.lang.map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=np.int64)
    counts[row, found.bucket.to_numpy(dtype=np.int64)] = found.n  # bucket -1 is the last
    grams, texts = counts[:, :-1] + SMOOTHING, counts[:, -1]
    log_probs = np.log(grams) - np.log(grams.sum(axis=1, keepdims=True))
    return Model(languages, log_probs, np.log(texts) - np.log(max(1.0, texts.sum())))


def score(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language and its posterior probability, for each of some non-empty texts."""
    orders, begins, lengths = _ngrams(texts)
    sums = np.empty((len(model.languages), len(texts)))
    borders = np.stack([begins, begins + lengths], axis=1).ravel()
    for i, log_prob in enumerate(model.log_probs):
        place = log_prob[orders[0]]
        for buckets in orders[1:]:
            place += log_prob[buckets]
        sums[i] = np.add.reduceat(place, borders)[::2] + model.log_priors[i]
    best = sums.argmax(axis=0)
    return best, 1 / np.exp(sums - sums.max(axis=0)).sum(axis=0)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def detect(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row of ``documents``.

    A text that is null or has no letter, and every text if the model knows no
    language, is ``und`` with score 0. Ties go to the language first in order.
    """
    sent = spark.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, model = batch.column("text").to_pylist(), sent.value
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if model.languages and _has_letter(t)]
        for a, b in slices([len(texts[i]) for i in known], SLICE):
            best, sure = score([texts[i] for i in known[a:b]], model)
            for i, lang in zip(known[a:b], best.tolist()):
                names[i] = model.languages[lang]
            scores[known[a:b]] = sure
        return pa.record_batch([batch.column("doc_id"), pa.array(names), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each_batch(make), "doc_id long, lang_pred string, score double")
