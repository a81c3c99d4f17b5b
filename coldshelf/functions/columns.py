"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from coldshelf.spec import Granularity, Window, quoted

UNSAFE_CHARACTERS = "[^A-Za-z0-9_-]"


def col(name: str) -> Column:
    return F.col(quoted(name))


def archive_key(date_col: Column, granularity: Granularity) -> Column:
    """Directory key of a row: a formatted date, ``unknown`` for NULL, or ``all``."""
    if granularity is Granularity.NONE:
        return F.lit("all")
    return F.coalesce(F.date_format(date_col, granularity.value), F.lit("unknown"))


def require_date(schema: T.StructType, date_col: str) -> T.DataType:
    """The type of the date column; anything but a date or timestamp is an error."""
    kind = schema[date_col].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"column '{date_col}' is {kind.simpleString()}, not a date or timestamp")
    return kind


def in_window(date_col: Column, window: Window, kind: T.DataType) -> Column:
    """Half-open window test; the bounds take the column's type so the scan gets the filter."""
    start, end = (F.lit(d).cast(kind) for d in (window.start, window.end))
    return (date_col >= start) & (date_col < end)


def safe_key(text: Column) -> Column:
    """Replace every character that is not safe in a path by ``_``."""
    return F.regexp_replace(text, UNSAFE_CHARACTERS, "_")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def boolean_from_text(text: Column) -> Column:
    """``true`` in any case is true; every other text is false; NULL stays NULL."""
    return F.lower(text) == "true"


def _only_widens(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of the source type fits the target type."""
    integers = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if source in integers and target in integers:
        return integers.index(source) < integers.index(target)
    return isinstance(source, T.FloatType) and isinstance(target, T.DoubleType)


def exact_cast(name: str, source: T.DataType, target: T.DataType) -> Column:
    """Cast that fails, naming the column, instead of turning a value into NULL.

    Decimals are rescaled half up. The failure does not depend on the session's
    ANSI setting.
    """
    value = col(name)
    if source == target:
        return value
    if _only_widens(source, target):
        return value.cast(target).alias(name)
    if isinstance(target, T.BooleanType) and isinstance(source, T.StringType):
        return boolean_from_text(value).alias(name)
    converted = value.try_cast(target)
    message = F.concat(
        F.lit(f"column '{name}' does not fit {target.simpleString()}: "), value.cast("string")
    )
    return (
        F.when(value.isNotNull() & converted.isNull(), F.raise_error(message))
        .otherwise(converted)
        .alias(name)
    )
