"""A table kept outside Spark, reached through functions the caller supplies.

``jdbc_table`` builds one for a database. Rows are read and written by Spark.
A delete hands the archived rows, batch by batch and inside tasks, to the
caller's ``delete_rows``, which removes those rows and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from coldshelf.operators.delete import delete_in_batches
from coldshelf.session import scratch_dir
from coldshelf.sources.scan import window_count
from coldshelf.spec import DEFAULTS, TableSpec, Window

DeleteRows = Callable[[pa.Table], int]


@dataclass(frozen=True)
class LiveTable:
    """``reader`` re-reads the table on every call.

    ``delete_rows(archived)`` is called inside tasks, with at most
    ``delete_batch_rows`` archived rows in the table's columns and types, or
    with their key columns alone where a transform changed the others. In one
    transaction it must remove every row that equals one of these in all columns
    given (NULL equals NULL), and return how many rows with one of the keys are
    left: rows that changed since the proof, which must stay. Rows that are gone
    already are no failure, since a task may run twice. ``delete_tasks`` is how
    many of these run at once. ``writer`` must insert all rows or none.
    ``not_null`` names the columns that the database declares NOT NULL.
    """

    reader: Callable[[], DataFrame]
    delete_rows: DeleteRows
    writer: Callable[[DataFrame], None]
    delete_batch_rows: int = DEFAULTS.delete_batch_rows
    delete_tasks: int = 8
    not_null: tuple[str, ...] = ()

    def read(self, window: Window | None = None) -> DataFrame:
        return self.reader()

    def schema(self) -> T.StructType:
        return self.reader().schema

    def oldest_part(self, spec: TableSpec) -> DataFrame:
        return self.reader()

    def state_of(self, window: Window) -> None:
        """Unknown: the table may always have changed."""
        return None

    def delete_window(
        self, spec: TableSpec, window: Window, expected: int, archived: DataFrame
    ) -> int:
        """Delete the archived rows, and only those; returns how many are gone from the table.

        Rows that differ from their archived version stay, and so do rows that
        came into the window after the proof. Either makes the delete fail,
        with everything that is in the archive gone.
        """
        batches = delete_in_batches(archived, spec.pk, self.delete_batch_rows, self.delete_tasks, self.delete_rows)
        path = scratch_dir(archived.sparkSession, "deleted")
        batches.write.parquet(path)
        counts = archived.sparkSession.read.schema(batches.schema).parquet(path)
        zero = F.lit(0)
        total, left = counts.agg(F.coalesce(F.sum("n_rows"), zero), F.coalesce(F.sum("n_left"), zero)).first()
        if left:
            raise ValueError(f"{left} archived key(s) hold other values by now: those rows stay, {total - left} are gone")
        others = window_count(self.reader(), spec, window).first().n_rows
        if others:
            raise ValueError(f"{others} row(s) of the window are not in the archive: they stay, {total} are gone")
        return total

    def insert(self, rows: DataFrame, spec: TableSpec) -> int:
        count = rows.count()
        self.writer(rows)
        return count


def jdbc_options(
    url: str,
    table: str,
    pk: str,
    lower: Any,
    upper: Any,
    partitions: int,
    fetch_rows: int = 1000,
) -> dict[str, str]:
    """Options of a parallel JDBC read split on the key; filters are pushed into the query."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": pk,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
    }


def jdbc_table(
    spark: SparkSession,
    options: dict[str, str],
    delete_rows: DeleteRows,
    publish: Callable[[str], None],
    not_null: tuple[str, ...] | None = None,
) -> LiveTable:
    """A database table.

    An insert fills a staging table from many tasks; ``publish(staging)`` then
    has to move its rows with one ``INSERT ... SELECT`` and drop it. The NOT
    NULL columns are looked up in the database's catalog unless given.
    """
    if not_null is None:
        not_null = required_columns(spark, options, options["dbtable"])

    def fill(rows: DataFrame, staging: str) -> None:
        target = {k: options[k] for k in options if k in ("url", "user", "password", "driver")}
        rows.write.format("jdbc").options(**target, dbtable=staging).mode("errorifexists").save()

    def reader() -> DataFrame:
        return spark.read.format("jdbc").options(**options).load()

    return LiveTable(reader, delete_rows, staged_writer(fill, publish, options["dbtable"]), not_null=not_null)


def staged_writer(
    fill: Callable[[DataFrame, str], None], publish: Callable[[str], None], table: str
) -> Callable[[DataFrame], None]:
    """A writer that inserts all rows or none: ``fill`` writes a new staging table in parallel, ``publish`` moves it.

    A staging table is never used twice, so what a failed attempt left in one is not published.
    """

    def write(rows: DataFrame) -> None:
        parts = name_parts(table)
        staging = ".".join([*parts[:-1], f"{parts[-1]}_{uuid.uuid4().hex[:12]}"])
        fill(rows, staging)
        publish(staging)

    return write


def name_parts(table: str) -> list[str]:
    """Catalog, schema and name of a table as far as given, without quotes."""
    parts = [p.strip().strip('"`[]') for p in table.split(".")]
    if not 1 <= len(parts) <= 3 or not all(parts) or "(" in table:
        raise ValueError(f"{table!r} is not a table name; name its NOT NULL columns in not_null")
    return parts


def required_columns(spark: SparkSession, options: dict[str, str], table: str) -> tuple[str, ...]:
    """Names of the NOT NULL columns, from the database's own catalog views.

    Spark's JDBC reader reports every column as nullable.
    """
    target = {k: v for k, v in options.items() if k in ("url", "user", "password", "driver")}
    catalog = spark.read.format("jdbc").options(**target, dbtable="information_schema.columns").load()
    return declared_not_null(catalog, table)


def declared_not_null(catalog: DataFrame, table: str) -> tuple[str, ...]:
    """The table's NOT NULL columns in ``information_schema.columns``.

    ``table`` may be qualified by schema, or by catalog and schema. Names agree
    whatever their case, unless one agrees exactly. No such table, or several
    of that name, is an error.
    """
    parts = name_parts(table)
    levels = ["table_catalog", "table_schema", "table_name"]
    named = catalog.select(*[F.col(c).alias(c) for c in (*levels, "column_name", "is_nullable", "ordinal_position")])
    for level, part in zip(levels[-len(parts) :], parts):
        named = named.where(F.lower(level) == part.lower())
    columns = named.orderBy("ordinal_position").collect()
    found = {tuple(r[c] for c in levels) for r in columns}
    exact = {f for f in found if list(f[-len(parts) :]) == parts}
    found = exact or found
    if len(found) != 1:
        which = ", ".join(sorted(".".join(str(x) for x in f) for f in found)) or "none"
        raise ValueError(f"the database's catalog must hold one table {table!r}; it has: {which}")
    return tuple(r.column_name for r in columns if tuple(r[c] for c in levels) in found and r.is_nullable == "NO")
