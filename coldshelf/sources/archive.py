"""Reading archive files named one by one, each checked against the expected columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from coldshelf.spec import quoted

# Footer entry in which Spark's Parquet writer stores the schema of a file.
SPARK_SCHEMA_ENTRY = b"org.apache.spark.sql.parquet.row.metadata"

UNSUPPORTED = "unsupported file system"


class ArchiveSchemaError(ValueError):
    """A named file is missing, unreadable or does not have the expected columns."""


def named_files(spark: SparkSession, files: list[str] | DataFrame) -> DataFrame:
    """``(file_path)`` of files given as a list, or as a table with that column."""
    if isinstance(files, DataFrame):
        return files.select("file_path")
    return spark.createDataFrame([(f,) for f in files], "file_path string")


def file_columns(spark: SparkSession, files: list[str] | DataFrame) -> DataFrame:
    """Names and types of the columns in each named file; only footers are read, in tasks."""

    # Nested, so that executors receive it by value and need not have this package.
    def footer(path: str) -> tuple[str | None, str | None]:
        import json

        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        local = path[len("file:") :] if path.startswith("file:/") else path
        try:
            if local.startswith("/"):
                store, inner = pafs.LocalFileSystem(), "/" + local.lstrip("/")
            else:
                store, inner = pafs.FileSystem.from_uri(local)
        except (pa.ArrowException, OSError, ImportError):
            return None, UNSUPPORTED
        try:
            entries = pq.read_metadata(inner, filesystem=store).metadata or {}
        except FileNotFoundError:
            return None, "the file does not exist"
        except (pa.ArrowException, OSError) as broken:
            return None, f"not a readable Parquet file ({broken})"
        if SPARK_SCHEMA_ENTRY not in entries:
            return None, "the file was not written by an export"
        return T.StructType.fromJson(json.loads(entries[SPARK_SCHEMA_ENTRY])).simpleString(), None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(path, *footer(path)) for path in batch["file_path"]]
            yield pd.DataFrame(found, columns=["file_path", "columns", "problem"])

    return (
        named_files(spark, files)
        .repartition("file_path")
        .mapInPandas(read, "file_path string, columns string, problem string")
    )


def check_files(spark: SparkSession, files: list[str] | DataFrame, expected: T.StructType) -> None:
    """Fail unless every named file exists and has the expected column names and types."""
    wanted = expected.simpleString()
    named = F.when(~F.col("file_path").endswith(".parquet"), "not named like a part file")
    wrong = (
        file_columns(spark, files)
        .withColumn("problem", F.coalesce("problem", named))
        .where(F.col("problem").isNotNull() | (F.col("columns") != wanted))
        .orderBy("file_path")
        .first()
    )
    if wrong is None:
        return
    raise ArchiveSchemaError(f"{wrong.file_path}: {wrong.problem or f'expected {wanted}, found {wrong.columns}'}")


def archive_scan(spark: SparkSession, files: list[str] | DataFrame, expected: T.StructType) -> DataFrame:
    """Rows of exactly the named files, after checking each of them; a file named twice is an error.

    The folders that hold them are read, and of those the rows whose file is
    among the names. Only the folders pass through the driver: there is one for
    each archive key, however many files it has.
    """
    names = named_files(spark, files)
    if names.isEmpty():
        raise ValueError("no archive file was named")
    check_files(spark, names, expected)
    twice = names.groupBy(_without_store("file_path").alias("place")).count().where("count > 1").first()
    if twice is not None:
        raise ArchiveSchemaError(f"{twice.place} is named {twice['count']} times")
    folder = F.regexp_replace("file_path", "/[^/]*$", "")
    folders = names.select(folder.alias("given"), _without_store(folder).alias("folder")).groupBy("folder").agg(F.min("given").alias("given"))
    # Part files right in the folders; characters that patterns give a meaning are taken literally.
    literal = F.regexp_replace("given", r"([\\*?{}\[\]^])", r"\\$1")
    rows = spark.read.schema(expected).parquet(*[r.place for r in folders.select(F.concat(literal, F.lit("/*.parquet")).alias("place")).collect()])
    # The reader's own paths are encoded as in a URI.
    own = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    wanted = names.select(_without_store("file_path").alias(FILE)).distinct()
    return rows.withColumn(FILE, own).withColumn(FILE, _without_store(FILE)).join(wanted, FILE, "left_semi").select(
        *[F.col(quoted(c)) for c in expected.names]
    )


FILE = "__coldshelf_file"


def _without_store(path: Column | str) -> Column:
    """The path without scheme and host, with single slashes."""
    return F.regexp_replace(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9.-]*:(//[^/]*)?", ""), "/+", "/")
