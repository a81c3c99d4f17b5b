"""What several operators use: written intermediate tables and row batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from coldshelf.session import scratch_dir


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """``frame`` as a table in the shared folder, so that it is computed once and its lineage ends there.

    Tasks that are rerun after an executor is lost read the table again and not what led to it.
    """
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most so many rows, which bounds what a Python worker holds at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def each_batch(
    make: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that turns one small batch of rows into one other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = make(batch)
            if made is not None and made.num_rows:
                yield made

    return run


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to about ``limit``; one larger item is a range of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all columns of ``frame``."""
    taken = {c.lower() for c in frame.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        made.append(name)
    return made
