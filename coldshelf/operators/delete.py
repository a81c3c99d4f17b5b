"""Delete side: which rows go, which stay, and key ranges for batched deletes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as Window_, functions as F

from coldshelf.functions.columns import col
from coldshelf.operators.membership import by_membership
from coldshelf.session import scratch_dir
from coldshelf.sources.scan import window_filter, window_scan
from coldshelf.spec import TableSpec, Window


def delete_targets(table: DataFrame, archived: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Rows of the table whose key is among the archived keys."""
    return by_membership(table, archived, pk, "left_semi", null_safe=False)


def survivors(table: DataFrame, archived: DataFrame, spec: TableSpec, window: Window) -> DataFrame:
    """The table without the window's rows whose keys are archived; rows with a NULL key always stay.

    Rows outside the window cannot be archived ones: they are passed on without being moved.
    """
    inside = F.coalesce(window_filter(table.schema, spec, window), F.lit(False))
    kept = by_membership(table.where(inside), archived, spec.pk, "left_anti", null_safe=False)
    return table.where(~inside).unionByName(kept)


def survivors_of_window(table: DataFrame, spec: TableSpec, window: Window) -> DataFrame:
    """The table without the window's rows, as a plain filter.

    Only right where reconcile has proved, for these very files of the table,
    that the window's rows are the archived rows; then no join is needed.
    """
    return table.where(~F.coalesce(window_filter(table.schema, spec, window), F.lit(False)))


def delete_batch_plan(table: DataFrame, spec: TableSpec, window: Window, batch_rows: int) -> DataFrame:
    """Disjoint key ranges of at most ``batch_rows`` rows that cover the window.

    Keys are range-partitioned, sorted where they land and cut every
    ``batch_rows`` rows, so no task sees more than its own range and only the
    last batch of each range is short. The bounds of a key of several columns
    are structs, in lexicographic order.
    """
    key = col(spec.pk[0]) if len(spec.pk) == 1 else F.struct(*[col(c) for c in spec.pk])
    # monotonically_increasing_id holds the partition in its upper bits and the
    # row's position inside the partition in the lower 33.
    placed = (
        window_scan(table, spec, window)
        .select(key.alias("pk"))
        .repartitionByRange("pk")
        .sortWithinPartitions("pk")
        .withColumn("place", F.monotonically_increasing_id())
    )
    position = F.col("place").bitwiseAND((1 << 33) - 1)
    return (
        placed.groupBy(
            F.shiftright("place", 33).alias("range_no"),
            F.floor(position / batch_rows).alias("batch_in_range"),
        )
        .agg(F.min("pk").alias("first_pk"), F.max("pk").alias("last_pk"), F.count("*").alias("n_rows"))
        .select("range_no", "batch_in_range", "first_pk", "last_pk", "n_rows")
    )


def global_batch_plan(table: DataFrame, spec: TableSpec, window: Window, batch_rows: int) -> DataFrame:
    """Batches of exactly ``batch_rows`` rows in the order of the key over the whole window; only the last is short.

    ``(batch_no, first_pk, last_pk, n_rows, splits_key)``, bounds as in
    ``delete_batch_plan``. ``splits_key`` marks a batch that begins with the key
    the one before it ends with, which only repeated keys can do. Rows are
    numbered by their range and place; the window function over all rows sees
    one row per range, the one over batches one row per batch.
    """
    keys = [col(c) for c in spec.pk]
    key = keys[0] if len(keys) == 1 else F.struct(*keys)
    ranges = window_scan(table, spec, window).select(key.alias("pk")).repartitionByRange("pk").sortWithinPartitions("pk")
    path = scratch_dir(table.sparkSession, "ranges")
    ranges.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = table.sparkSession.read.parquet(path).select(
        "pk", F.shiftright("place", 33).alias("range_no"), F.col("place").bitwiseAND((1 << 33) - 1).alias("at")
    )
    sizes = placed.groupBy("range_no").agg(F.count("*").alias("n"))
    before = sizes.select("range_no", (F.sum("n").over(Window_.orderBy("range_no")) - F.col("n")).alias("before"))
    number = F.floor((F.col("before") + F.col("at")) / batch_rows).alias("batch_no")
    batches = (
        placed.join(F.broadcast(before), "range_no")
        .groupBy(number)
        .agg(F.min("pk").alias("first_pk"), F.max("pk").alias("last_pk"), F.count("*").alias("n_rows"))
    )
    earlier = F.lag("last_pk").over(Window_.orderBy("batch_no"))
    return batches.withColumn("splits_key", F.coalesce(earlier == F.col("first_pk"), F.lit(False)))


def delete_in_batches(
    archived: DataFrame,
    pk: tuple[str, ...],
    batch_rows: int,
    tasks: int,
    delete_rows: Callable[[pa.Table], int],
) -> DataFrame:
    """Hand archived rows to ``delete_rows`` in key order, batch by batch, inside tasks.

    One row per batch: ``n_rows`` archived rows, of whose keys ``n_left`` are
    still in the table afterwards. ``tasks`` bounds how many batches run at once.
    A task that runs again hands its batches over again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, batch_rows):
                some = pa.Table.from_batches([batch.slice(i, batch_rows)])
                yield pa.record_batch([[some.num_rows], [delete_rows(some)]], names=["n_rows", "n_left"])

    keys = [col(c) for c in pk]
    placed = archived.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "n_rows long, n_left long")
