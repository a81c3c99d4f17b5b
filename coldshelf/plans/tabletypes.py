"""Between a table's own columns and those of its archive."""

from __future__ import annotations

from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from coldshelf.spec import TableSpec, archive_schema, quoted


def with_declared(spec: TableSpec, table: Any) -> TableSpec:
    """The spec with the columns added that the table itself declares NOT NULL."""
    declared = [f.name for f in table.schema().fields if not f.nullable]
    declared += getattr(table, "not_null", ())
    return replace(spec, required=tuple(dict.fromkeys((*spec.required, *declared))))


def as_source(rows: DataFrame, table: T.StructType) -> DataFrame:
    """Archived columns back in the table's types, e.g. a widened small integer."""
    stored = archive_schema(table)
    return rows.select(
        *[
            F.col(quoted(c)).cast(table[c].dataType).alias(c)
            if c in table.names and stored[c].dataType == rows.schema[c].dataType
            else F.col(quoted(c))
            for c in rows.columns
        ]
    )
