"""Token ids of documents in binary files, in ascending order of doc_id.

Texts are encoded by the tokenizers library with a byte-level BPE vocabulary.
A text is cut before each space that follows a visible ASCII character or a
letter of the Latin-1 range, and between a small ASCII letter and a point or
comma: the vocabulary's pattern begins a new pre-token at both, whatever stands
around, so the ids of the pieces are those of the whole text. Each distinct piece
is encoded once, found again by a hash and compared (see ``chunk_memo``).

A folder of token files holds Parquet files of one range of ids each. A row
is a document: ``part``, the range; ``row``, its place in it; ``doc_id``;
``ids``, a list coded as in ``simple8b``. Parquet gives what plain binary
files would lack here: a commit when all tasks are done, so that a lost
executor leaves no half-written file, and any store that Spark can write.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from coldshelf.llm import simple8b
from coldshelf.llm.chunk_memo import HashedMemo
from coldshelf.llm.shared import each_batch, slices, written

END_ID = 0
#: Characters handled at a time within a batch.
SLICE = 1 << 20

#: A word of Latin letters, perhaps after a space: one pre-token.
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")


@cache
def _memo(vocabulary: str) -> HashedMemo:
    """One for each Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import Sequence

    tokenizer = Tokenizer.from_file(vocabulary)
    # The same merges without the search for pre-tokens, for pieces that are one pre-token.
    bare = Tokenizer.from_file(vocabulary)
    bare.pre_tokenizer = Sequence([])
    shown = _shown_bytes()

    def encode(pieces: list[str]) -> list[list[int]]:
        made: list[list[int]] = [[]] * len(pieces)
        words, rest = [], []
        for i, piece in enumerate(pieces):
            (words if _WORD.fullmatch(piece) else rest).append(i)
        for some, how in ((words, bare), (rest, tokenizer)):
            texts = [pieces[i] for i in some]
            if how is bare:
                texts = [
                    t.replace(" ", chr(shown[32])) if t.isascii() else t.encode().decode("latin-1").translate(shown)
                    for t in texts
                ]
            for k in range(0, len(some), 10_000):
                for i, e in zip(some[k:], how.encode_batch_fast(texts[k : k + 10_000], add_special_tokens=False)):
                    made[i] = e.ids
        return made

    return HashedMemo(_cuts, encode)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces begin in UTF-8 bytes, as a mask."""
    before, two_before = np.zeros_like(data), np.zeros_like(data)
    before[1:], two_before[2:] = data[:-1], data[:-2]
    # Two bytes from C3 on are a letter, but for the signs of multiplication and division.
    latin = (two_before == 0xC3) & (before != 0x97) & (before != 0xB7)
    space = (data == 32) & (((before > 32) & (before < 127)) | latin)
    return space | (((data == 46) | (data == 44)) & (before >= 97) & (before <= 122))


def _shown_bytes() -> dict[int, int]:
    """The character by which byte-level vocabularies show each byte: itself if visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


def encode_texts(texts: list[str | None], vocabulary: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and their number by text; ``end_id`` follows each text. Null is empty."""
    ids, sizes = _memo(vocabulary).encode([t or "" for t in texts])
    if end_id is not None:
        ids = np.insert(ids, np.cumsum(sizes), end_id)
        sizes = sizes + 1
    return ids, sizes


def write_token_files(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str, end_id: int | None = END_ID) -> None:
    """Encode each text of ``documents`` and write the ids to ``path`` in ascending doc_id order.

    Null ids come first. Rows with equal ids stand next to each other, those
    with smaller coded lists first. Texts are encoded before they are moved,
    and only coded ids are shuffled.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    bounds = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 20 * parts)).first()[0] or []
    bounds = np.unique(np.array(bounds, dtype=np.int64))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        coded: list[bytes] = []
        for a, b in slices([len(t or "") for t in texts], SLICE):
            coded += simple8b.encode(*encode_texts(texts[a:b], vocabulary, end_id))
        id_or_least = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
        part = np.searchsorted(bounds, id_or_least, side="left").astype(np.int32)
        return pa.record_batch([pa.array(part), batch.column("doc_id"), pa.array(coded, pa.binary())], names=["part", "doc_id", "ids"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            yield batch.append_column("row", pa.array(np.arange(n, n + batch.num_rows)))
            n += batch.num_rows

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = rows.mapInArrow(each_batch(make), "part int, doc_id long, ids binary")
    (
        coded.repartitionById(len(bounds) + 1, "part")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(number, "part int, doc_id long, ids binary, row long")
        .write.parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(part, row, doc_id, ids)``, one row per document, with ``ids`` as an array of longs."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, sizes = simple8b.decode(batch.column("ids").to_pylist())
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64)))
        return pa.record_batch([batch.column(c) for c in ("part", "row", "doc_id")] + [lists], names=["part", "row", "doc_id", "ids"])

    return spark.read.parquet(path).select("part", "row", "doc_id", "ids").mapInArrow(each_batch(make), "part int, row long, doc_id long, ids array<long>")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document in the token files at ``path``.

    ``start`` counts the ids of all documents before it, over all files.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, sizes = simple8b.decode(batch.column("ids").to_pylist())
        ends = np.cumsum(sizes)
        ids = values.astype("<u4")
        crcs = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]
        found = [batch.column(c) for c in ("part", "row", "doc_id")]
        return pa.record_batch([*found, pa.array(sizes), pa.array(crcs, pa.int64())], names=["part", "row", "doc_id", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(path).select("part", "row", "doc_id", "ids")
    found = rows.mapInArrow(each_batch(make), "part int, row long, doc_id long, n_tokens long, ids_crc32 long")
    found = written(spark, found, "token-index")
    # One row for each file: the ids in all files before it.
    totals = found.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    return (
        found.withColumn("inside", inside)
        .join(before, "part")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
