"""Export: key the rows, write partitioned Parquet, list what was written."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from coldshelf.functions.columns import UNSAFE_CHARACTERS, archive_key, col, require_date
from coldshelf.operators.reconcile import key_profile
from coldshelf.sources.scan import typed_projection
from coldshelf.spec import TableSpec, Window, archive_schema

KEY = "archive_key"
WINDOW = "archive_window"

#: For files that are many and small. Hadoop's default for local files adds a checksum file to each and, without its
#: native library, starts a process for each of the two to set permissions, which is most of the time; this leaves one.
#: Parquet pages have checksums of their own. Other stores do not read these settings.
MANY_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


@dataclass(frozen=True)
class ExportStats:
    """What the writer saw: rows handed to it, and NULLs in required columns."""

    rows: int
    null_rows: dict[str, int]


def with_archive_key(rows: DataFrame, spec: TableSpec) -> DataFrame:
    require_date(rows.schema, spec.date_col)
    return rows.withColumn(KEY, archive_key(col(spec.date_col), spec.granularity))


def rows_per_key(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return with_archive_key(rows, spec).groupBy(KEY).agg(F.count("*").alias("n_rows"))


def archive_rows(
    rows: DataFrame,
    spec: TableSpec,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The rows as the archive stores them; reconcile applies the same to the live side.

    Whether a transform kept all rows is for ``refuse_lost_rows`` to say.
    """
    if transform is not None:
        changed = rows.transform(transform)
        for name in (*spec.pk, spec.date_col):
            if name not in changed.columns or changed.schema[name].dataType != rows.schema[name].dataType:
                raise ValueError(f"the transform must keep column '{name}' as it is")
        rows = changed
    return typed_projection(rows, archive_schema(rows.schema))


def refuse_lost_rows(rows: DataFrame, stored: DataFrame, pk: tuple[str, ...]) -> None:
    """Fail if a transform dropped, added or renamed rows: what is not archived would be deleted too."""
    seen = key_profile(rows, stored, pk)
    if seen.source_rows != seen.archive_rows or seen.missing_in_archive or seen.missing_in_source:
        raise ValueError(
            f"the transform made {seen.archive_rows} rows of {seen.source_rows}, "
            f"with {seen.missing_in_archive} keys lost and {seen.missing_in_source} new"
        )


def clustered(rows: DataFrame, key: str, pk: tuple[str, ...]) -> DataFrame:
    """Bring each key's rows together without giving a large key to one task.

    ``rebalance`` shuffles by key, then adaptive execution cuts an oversized
    key over several tasks and packs small keys into one, so a month holding a
    third of the rows is still written in parallel. Without adaptive execution
    every key is spread over the shuffle partitions, whose number the user sets
    by the size of the data.
    """
    conf = rows.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", key)
    salts = F.lit(4 * int(conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(F.col(key), F.pmod(F.xxhash64(*[col(c) for c in pk]), salts))


def safe_name(text: str) -> str:
    """A table name or run token with every character that is unsafe in a path replaced."""
    return re.sub(UNSAFE_CHARACTERS, "_", text)


def file_stem(spec: TableSpec, run_token: str, at: datetime) -> str:
    """Start of every part file name of one run; Spark adds task number and a UUID."""
    stem = f"{safe_name(spec.name)}_run-{at:%Y%m%dT%H%M%S}_token-{safe_name(run_token or 'norun')}"
    # Readers skip files whose name starts with an underscore.
    return "t" + stem if stem.startswith("_") else stem


def write_archive(rows: DataFrame, spec: TableSpec, path: str, stem: str | None = None) -> ExportStats:
    """Write the rows under ``path``, which must not exist yet.

    Rows and NULLs in required columns are counted by the writing tasks
    themselves (after the shuffle, where a retried task is counted once).
    """
    seen = Observation()
    counters = [F.count("*").alias("rows")] + [
        F.count_if(col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(spec.required)
    ]
    writer = (
        clustered(with_archive_key(rows, spec), KEY, spec.pk)
        .observe(seen, *counters)
        .sortWithinPartitions(KEY, *[col(c) for c in spec.pk])
        .write.mode("errorifexists")
        .partitionBy(KEY)
        .option("compression", "snappy")
    )
    if stem:
        writer = writer.option("mapreduce.output.basename", stem)
    if spec.max_rows_per_file > 0:
        writer = writer.options(maxRecordsPerFile=spec.max_rows_per_file, **MANY_FILES)
    writer.parquet(path)
    got = seen.get
    return ExportStats(got["rows"], {c: got[f"nulls_{i}"] for i, c in enumerate(spec.required)})


def window_number(date_col: Column, windows: list[Window]) -> Column:
    """Which of consecutive windows a date lies in, from 1."""
    starts = F.array(*[F.lit(w.start) for w in windows])
    return F.size(F.filter(starts, lambda start: start <= F.to_date(date_col)))


def write_windows(
    rows: DataFrame, spec: TableSpec, path: str, stem: str, windows: list[Window], sizes: list[int]
) -> ExportStats:
    """As ``write_archive``, for consecutive windows at once, each in a folder ``archive_window=<start>`` of its own.

    A task writes rows of one window only, so no base name occurs in two of
    them. ``sizes`` are the rows expected in each window: a window gets its
    share of the tasks, at least one.
    """
    total, tasks = max(1, sum(sizes)), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [max(1, math.ceil(tasks * n / total)) for n in sizes]
    offsets = [sum(parts[:i]) for i in range(len(parts))]
    nth = window_number(col(spec.date_col), windows)
    first, own = (F.element_at(F.array(*map(F.lit, x)), nth) for x in (offsets, parts))
    task = first + F.pmod(F.xxhash64(*[col(c) for c in spec.pk]), own).cast("int")
    names = F.element_at(F.array(*[F.lit(w.start.isoformat()) for w in windows]), nth)
    seen = Observation()
    counters = [F.count("*").alias("rows")] + [
        F.count_if(col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(spec.required)
    ]
    writer = (
        with_archive_key(rows, spec)
        .withColumn(WINDOW, names)
        .repartitionById(sum(parts), task)
        .observe(seen, *counters)
        .sortWithinPartitions(KEY, *[col(c) for c in spec.pk])
        .write.mode("errorifexists")
        .partitionBy(WINDOW, KEY)
        .option("compression", "snappy")
        .option("mapreduce.output.basename", stem)
    )
    if spec.max_rows_per_file > 0:
        writer = writer.options(maxRecordsPerFile=spec.max_rows_per_file, **MANY_FILES)
    writer.parquet(path)
    got = seen.get
    return ExportStats(got["rows"], {c: got[f"nulls_{i}"] for i, c in enumerate(spec.required)})


def window_path(path: str, window: Window) -> str:
    """Where ``write_windows`` puts a window: a run of its own for ``read_archive``."""
    return f"{path}/{WINDOW}={window.start.isoformat()}"


def read_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All files of a run over several windows, with the window and key columns."""
    keyed = [T.StructField(c, T.StringType()) for c in (WINDOW, KEY)]
    return spark.read.schema(T.StructType([*schema.fields, *keyed])).parquet(path)


def windows_manifest(archive: DataFrame, path: str) -> DataFrame:
    """As ``manifest``, with the start of each file's window."""
    counted = archive.groupBy(F.col("_metadata.file_name").alias("base_name"), WINDOW, KEY).agg(F.count("*").alias("n_rows"))
    folders = [F.concat(F.lit(f"{c}="), c) for c in (WINDOW, KEY)]
    return counted.select(
        *("base_name", KEY, "n_rows", F.to_date(WINDOW).alias("window_start")),
        F.concat_ws("/", F.lit(path), *folders, "base_name").alias("file_path"),
    )


def read_archive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All files of one run, with the key column. The schema is given, so an empty run reads too."""
    keyed = T.StructType(list(schema.fields) + [T.StructField(KEY, T.StringType())])
    return spark.read.schema(keyed).parquet(path)


def manifest(archive: DataFrame, path: str) -> DataFrame:
    """One row per part file below ``path`` with its row count; file footers are enough."""
    return (
        archive.groupBy(F.col("_metadata.file_name").alias("base_name"), F.col(KEY))
        .agg(F.count("*").alias("n_rows"))
        .withColumn(
            "file_path", F.concat_ws("/", F.lit(path), F.concat(F.lit(f"{KEY}="), KEY), "base_name")
        )
    )
