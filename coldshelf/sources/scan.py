"""Reading the source side: window filter, schema discovery, typed projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from coldshelf.functions.columns import col, exact_cast, in_window, require_date
from coldshelf.spec import TableSpec, Window, archive_schema, archive_type


def window_filter(schema: T.StructType, spec: TableSpec, window: Window) -> Column:
    """The window test and, in parentheses, the table's extra predicate."""
    kind = require_date(schema, spec.date_col)
    test = in_window(col(spec.date_col), window, kind)
    if spec.predicate:
        test = test & F.expr(f"({spec.predicate})")
    return test


def window_scan(table: DataFrame, spec: TableSpec, window: Window) -> DataFrame:
    """Every column of the rows in the window; rows with a NULL date never match."""
    return table.where(window_filter(table.schema, spec, window))


def window_count(table: DataFrame, spec: TableSpec, window: Window) -> DataFrame:
    return window_scan(table, spec, window).agg(F.count("*").alias("n_rows"))


def typed_projection(table: DataFrame, target: T.StructType | None = None) -> DataFrame:
    """Select the archive columns in order, converting types without loss of rows or values."""
    target = target or archive_schema(table.schema)
    return table.select(
        *[exact_cast(f.name, table.schema[f.name].dataType, f.dataType) for f in target.fields]
    )


def schema_discovery(
    table: DataFrame, required: tuple[str, ...] = (), count_nulls: bool = False
) -> DataFrame:
    """One row per column: ordinal, archive type and nullability; no row of the table is read.

    Parquet and JDBC scans report every column as nullable. With ``count_nulls``
    one pass over the whole table adds ``null_rows``, which tells what a caller
    may declare required.
    """
    fields = archive_schema(table.schema).fields
    described = []
    for i, f in enumerate(table.schema.fields):
        kind, stored = archive_type(f.name, f.dataType)
        decimal = isinstance(stored, T.DecimalType)
        counted = [F.col(f"nulls_{i}").alias("null_rows")] if count_nulls else []
        described.append(
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(kind).alias("archive_type"),
                F.lit(stored.precision if decimal else None).cast("int").alias("num_precision"),
                F.lit(stored.scale if decimal else None).cast("int").alias("num_scale"),
                F.lit(f.nullable and f.name not in required).alias("nullable"),
                *counted,
            )
        )
    counts = table.sparkSession.range(1)
    if count_nulls:
        nulls = [(F.count("*") - F.count(col(f.name))).alias(f"nulls_{i}") for i, f in enumerate(fields)]
        counts = table.agg(*nulls)
    return counts.select(F.inline(F.array(*described)))


def null_violations(table: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Count of NULLs per required column, all columns in one pass."""
    counts = table.agg(
        *[F.count_if(col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(required)]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{i}").alias("null_rows"))
                    for i, c in enumerate(required)
                ]
            )
        )
    )


def oldest_date(table: DataFrame, spec: TableSpec) -> DataFrame:
    """The earliest date in the table under the extra predicate; NULL for an empty table."""
    require_date(table.schema, spec.date_col)
    rows = table.where(F.expr(f"({spec.predicate})")) if spec.predicate else table
    return rows.agg(F.to_date(F.min(col(spec.date_col))).alias("oldest"))
