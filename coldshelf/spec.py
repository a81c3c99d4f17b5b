"""What a run needs to know about a table: key, date column, types, window."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from enum import Enum

from pyspark.sql import types as T


class Granularity(Enum):
    """How exported rows are grouped into archive directories."""

    EXACT_DATE = "yyyy-MM-dd"
    MONTH = "yyyy-MM"
    YEAR = "yyyy"
    NONE = None


@dataclass(frozen=True)
class Window:
    """Half-open date range ``[start, end)``."""

    start: date
    end: date

    def __post_init__(self):
        if self.start >= self.end:
            raise ValueError(f"window start {self.start} is not before its end {self.end}")

    def __str__(self):
        return f"[{self.start}, {self.end})"


@dataclass(frozen=True)
class TableSpec:
    """One table and how to archive it.

    ``predicate`` is a SQL boolean expression ANDed to every window filter.
    ``required`` names the columns that must not hold NULL: Parquet and JDBC
    reads report every column as nullable, so the caller has to say.
    """

    name: str
    pk: str | tuple[str, ...] = "id"
    date_col: str = "fye"
    predicate: str | None = None
    granularity: Granularity = Granularity.MONTH
    required: tuple[str, ...] = ()
    max_rows_per_file: int = 0

    def __post_init__(self):
        if not self.name or not self.name.strip():
            raise ValueError("a table name is required")
        keys = (self.pk,) if isinstance(self.pk, str) else tuple(self.pk)
        if not keys or not all(k.strip() for k in keys):
            raise ValueError(f"table '{self.name}': a primary key column is required")
        object.__setattr__(self, "pk", keys)
        if self.predicate is not None and not self.predicate.strip():
            object.__setattr__(self, "predicate", None)

    def with_predicate(self, predicate: str | None) -> TableSpec:
        return replace(self, predicate=predicate)


@dataclass(frozen=True)
class Defaults:
    """Defaults of a run; fixed values."""

    retention_years: int = 5
    window_months: int = 4
    delete_batch_rows: int = 500
    delete_enabled: bool = True
    dry_run: bool = False


DEFAULTS = Defaults()


def archive_type(column: str, source: T.DataType) -> tuple[str, T.DataType]:
    """The archive type name of a column and the Spark type it is stored as."""
    if isinstance(source, (T.StringType, T.CharType, T.VarcharType)):
        return "STRING", T.StringType()
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType)):
        return "INT", T.IntegerType()
    if isinstance(source, T.DecimalType):
        return "DECIMAL", source
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP", source
    for cls, name in (
        (T.LongType, "LONG"),
        (T.DoubleType, "DOUBLE"),
        (T.FloatType, "FLOAT"),
        (T.DateType, "DATE"),
        (T.BooleanType, "BOOLEAN"),
        (T.BinaryType, "BYTES"),
    ):
        if isinstance(source, cls):
            return name, source
    raise TypeError(f"column '{column}' has type {source.simpleString()}, which has no archive type")


def archive_schema(source: T.StructType) -> T.StructType:
    """Source columns in order, with small integers widened; refuses other types."""
    if not source.fields:
        raise ValueError("table was not found or has no columns")
    return T.StructType(
        [T.StructField(f.name, archive_type(f.name, f.dataType)[1], True) for f in source.fields]
    )


def same_columns(left: T.StructType, right: T.StructType) -> bool:
    """Equal names and types in the same order, ignoring nullability."""
    return [(f.name, f.dataType) for f in left.fields] == [(f.name, f.dataType) for f in right.fields]


def quoted(name: str) -> str:
    """A column name that Spark's resolver takes literally."""
    return "`" + name.replace("`", "``") + "`"
