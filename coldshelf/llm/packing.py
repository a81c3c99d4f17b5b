"""Packing of token sequences by bounded-space online best-fit.

Documents become pieces of at most ``capacity`` ids, and pieces fill sequences
of that many places. Each task packs its share of the pieces as they come and
holds a fixed number of open sequences. Their free places are the set bits of
one number, so the fullest sequence that still takes a piece is the lowest bit
from its length on. Where none takes it and no more may be open, the fullest
one closes. Pieces arrive in runs as long as there are open sequences, the
longest of a run first.

What is still open when a task ends is packed again, by a sixteenth of the
tasks, until one task is left: only that one leaves sequences part empty for
want of pieces. No task holds more than its open sequences.

A null text is an empty one, which is its end id alone. Null and repeated
doc_ids and equal texts are documents of their own. An empty table gives no
pieces and no sequences.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from coldshelf.llm.shared import each_batch, free_names, slices, small, written
from coldshelf.llm.token_files import END_ID, SLICE, encode_texts

CAPACITY = 2048
#: Sequences that one task keeps open, and pieces that it puts in order at a time.
OPEN = 1024
#: Pieces that one task packs in the first pass.
TASK_PIECES = 50_000
#: Tasks whose open sequences one task of the next pass packs again.
FAN_IN = 16


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int | None = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of each text of ``documents``: ``(doc_id, piece, start, length, ids_crc32)``.

    A text is its ids and ``end_id`` (none if that is None; then empty texts
    have no piece). Only texts longer than ``capacity`` are cut, into full
    pieces, but for the first. ``start`` counts the ids of the document before
    the piece; ``ids_crc32`` is over them as little-endian 32-bit numbers.
    ``with_ids`` adds them as ``ids``.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def of(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        counts = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = sizes - (counts - 1) * capacity
        start = np.where(nth == 0, 0, first[doc] + (nth - 1) * capacity)
        length = np.where(nth == 0, first[doc], capacity)
        begin = start + (np.cumsum(sizes) - sizes)[doc]
        coded = ids.astype("<u4")
        crcs = [zlib.crc32(coded[b:e]) for b, e in zip(begin.tolist(), (begin + length).tolist())]
        columns = [doc_ids.take(pa.array(doc)), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))))
        return pa.record_batch(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column("text").to_pylist()
            for a, b in slices([len(t or "") for t in texts], SLICE):
                yield of(batch.column("doc_id").slice(a, b - a), *encode_texts(texts[a:b], vocabulary, end_id))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def pack(
    spark: SparkSession,
    pieces: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN,
    task_pieces: int = TASK_PIECES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, the place of each in its sequence.

    Of the columns only ``length`` is looked at; it must be 1 to ``capacity``.
    Sequences are filled from 0 without gaps. Their ids are any distinct numbers.
    """
    if open_bins < 1 or fan_in < 2:
        raise ValueError("at least one open sequence, and two tasks into one")
    table = written(spark, pieces, "pieces")
    (still_open,) = free_names(table, "still_open")
    tasks = max(1, math.ceil(table.count() / task_pieces))
    closed, level = [], 0
    while True:
        schema = T.StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long").add(still_open, "boolean")
        fit = _best_fit(schema.names, pieces.columns.index("length"), capacity, open_bins, level, tasks == 1)
        packed = written(spark, table.repartition(tasks).mapInArrow(fit, schema), "packed")
        closed.append(packed.where(~F.col(still_open)).drop(still_open))
        if tasks == 1:
            break
        table = packed.where(F.col(still_open)).select(*[F.col(f"`{c}`") for c in pieces.columns])
        tasks, level = math.ceil(tasks / fan_in), level + 1
    whole = closed[0]
    for more in closed[1:]:
        whole = whole.union(more)
    return whole


def _best_fit(names: list[str], length_at: int, capacity: int, open_bins: int, level: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered = (level << 24 | TaskContext.get().partitionId()) << 32
        bins = OpenBins(capacity, open_bins, numbered)
        schema = None
        for batch in small(batches, open_bins):
            schema = schema or pa.schema([*batch.schema, ("sequence_id", pa.int64()), ("offset", pa.int64()), (names[-1], pa.bool_())])
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            if not all(r[length_at] is not None and 0 < r[length_at] <= capacity for r in rows):
                raise ValueError(f"a piece must have 1 to {capacity} ids")
            rows.sort(key=lambda r: -r[length_at])
            for row in rows:
                bins.put(row, row[length_at])
            yield from _batch(bins.closed(), False, schema)
        yield from _batch(bins.rest(), not last, schema)

    return run


def _batch(bins: list[tuple[int, list]], still_open: bool, schema: pa.Schema | None) -> Iterator[pa.RecordBatch]:
    made = [(*row, number, place, still_open) for number, held in bins for row, place in held]
    for i in range(0, len(made), 10_000):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*made[i : i + 10_000]), schema)]
        yield pa.record_batch(columns, schema=schema)


class OpenBins:
    """At most ``limit`` open bins, found by their free space; bit f of ``free`` is set if some bin has f places left."""

    def __init__(self, capacity: int, limit: int, first_number: int = 0) -> None:
        self._capacity, self._limit, self._next = capacity, limit, first_number
        self.free = self.count = 0
        self._bins: dict[int, list] = defaultdict(list)
        self._closed: list[tuple[int, list]] = []

    def put(self, item, length: int) -> None:
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number, held = self._take(space)
        else:
            if self.count == self._limit:
                self._closed.append(self._take((self.free & -self.free).bit_length() - 1))
            space = self._capacity
            number, held = self._next, []
            self._next += 1
        held.append((item, self._capacity - space))
        if space == length:
            self._closed.append((number, held))
        else:
            self._bins[space - length].append((number, held))
            self.free |= 1 << (space - length)
            self.count += 1

    def _take(self, space: int) -> tuple[int, list]:
        found = self._bins[space].pop()
        if not self._bins[space]:
            self.free ^= 1 << space
        self.count -= 1
        return found

    def closed(self) -> list[tuple[int, list]]:
        """The bins closed since the last call, as their number and their items with places."""
        found, self._closed = self._closed, []
        return found

    def rest(self) -> list[tuple[int, list]]:
        """All bins left."""
        found = self.closed() + [b for held in self._bins.values() for b in held]
        self._bins.clear()
        self.free = self.count = 0
        return found
