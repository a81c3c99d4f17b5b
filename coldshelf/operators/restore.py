"""Restore side: which window do the named files belong to, and the union."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coldshelf.functions.columns import base_name
from coldshelf.spec import same_columns

WINDOW_KEY = ["table_name", "window_start", "window_end"]


def lookup_files(given: DataFrame, recorded: DataFrame) -> DataFrame:
    """Named files (``file_path``) with the window that recorded their base name.

    The files may have moved since, so only base names are compared. A base
    name is recorded once per directory of a run; the record is made distinct
    before the join so that it cannot multiply the given files.
    """
    windows = recorded.select("base_name", *WINDOW_KEY, "run_token").distinct()
    return given.withColumn("base_name", base_name(F.col("file_path"))).join(windows, "base_name")


def unknown_files(given: DataFrame, recorded: DataFrame) -> DataFrame:
    """Named files whose base name no export of the table ever recorded."""
    names = recorded.select("base_name").distinct()
    return given.withColumn("base_name", base_name(F.col("file_path"))).join(
        names, "base_name", "left_anti"
    )


def window_check(found: DataFrame) -> DataFrame:
    """Into how many windows and runs the files fall; a restore needs exactly one of each."""
    return found.agg(
        F.count_distinct("window_start", "window_end").alias("n_windows"),
        F.count_distinct("run_token").alias("n_runs"),
        F.min("window_start").alias("window_start"),
        F.min("window_end").alias("window_end"),
        F.min("run_token").alias("run_token"),
    )


def resolve_files(given: DataFrame, recorded: DataFrame) -> DataFrame:
    """``window_check`` of the named files, with how many are unknown and one of those, in one pass."""
    windows = recorded.select("base_name", *WINDOW_KEY, "run_token").distinct()
    named = given.withColumn("base_name", base_name(F.col("file_path")))
    unknown = F.col("run_token").isNull()
    return named.join(windows, "base_name", "left").agg(
        F.count_if(unknown).alias("n_unknown"),
        F.min(F.when(unknown, F.col("base_name"))).alias("an_unknown"),
        F.count_distinct("window_start", "window_end").alias("n_windows"),
        F.count_distinct("run_token").alias("n_runs"),
        F.min("window_start").alias("window_start"),
        F.min("window_end").alias("window_end"),
        F.min("run_token").alias("run_token"),
    )


def restore_union(current: DataFrame, restored: DataFrame, allow_missing_columns: bool = False) -> DataFrame:
    """The table with the restored rows back.

    Columns must agree by name and type. With ``allow_missing_columns``, a
    column added to the table since the export is filled with NULL; a column
    the table has lost since is always an error.
    """
    lost = [c for c in restored.columns if c not in current.columns]
    if lost:
        raise ValueError(f"the table no longer has archived column(s) {lost}")
    added = [c for c in current.columns if c not in restored.columns]
    if added and not allow_missing_columns:
        raise ValueError(f"the archive lacks column(s) {added} of the table")
    rows = restored.select(
        *[
            F.lit(None).cast(current.schema[c].dataType).alias(c) if c in added else F.col(f"`{c}`")
            for c in current.columns
        ]
    )
    if not same_columns(rows.schema, current.schema):
        raise ValueError(
            f"column types differ: table {current.schema.simpleString()}, archive {rows.schema.simpleString()}"
        )
    return current.unionByName(rows)
