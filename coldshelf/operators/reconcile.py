"""Reconcile: prove an archive holds exactly the live rows, column by column."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from coldshelf.functions.columns import col
from coldshelf.operators.membership import by_membership
from coldshelf.session import scratch_dir
from coldshelf.spec import same_columns

MATCH = "match"
MISMATCH = "mismatch"
MISSING_IN_ARCHIVE = "missing_in_archive"
MISSING_IN_SOURCE = "missing_in_source"
DUPLICATE_KEY = "duplicate_key"


@dataclass(frozen=True)
class KeyProfile:
    """Counts from one pass over the key columns of both sides."""

    source_rows: int
    archive_rows: int
    duplicate_keys: int
    missing_in_archive: int
    missing_in_source: int


def duplicate_keys(table: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Key values held by more than one row; partial counts are merged before the shuffle."""
    return table.groupBy(*[col(c) for c in pk]).agg(F.count("*").alias("copies")).where("copies > 1")


def key_totals(table: DataFrame, pk: tuple[str, ...]) -> tuple[int, int]:
    """Rows of a table, and how many of its keys are held by more than one row."""
    per_key = table.groupBy(*[col(c) for c in pk]).agg(F.count("*").alias("copies"))
    row = per_key.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count_if(F.col("copies") > 1)).first()
    return row[0], row[1]


def key_census(source: DataFrame, archive: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Rows per key on each side. Reads the key columns only; NULL keys group together."""
    keys = [col(c) for c in pk]
    both = source.select(*keys, F.lit(1).alias("s"), F.lit(0).alias("a")).unionByName(
        archive.select(*keys, F.lit(0).alias("s"), F.lit(1).alias("a"))
    )
    return both.groupBy(*keys).agg(F.sum("s").alias("source_rows"), F.sum("a").alias("archive_rows"))


def key_counts(source: DataFrame, archive: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """The counts of a ``KeyProfile`` as one row."""
    s, a = F.col("source_rows"), F.col("archive_rows")
    return key_census(source, archive, pk).agg(
        F.coalesce(F.sum(s), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(a), F.lit(0)).alias("archive_rows"),
        F.count_if((s > 1) | (a > 1)).alias("duplicate_keys"),
        F.count_if(a == 0).alias("missing_in_archive"),
        F.count_if(s == 0).alias("missing_in_source"),
    )


def key_profile(source: DataFrame, archive: DataFrame, pk: tuple[str, ...]) -> KeyProfile:
    return KeyProfile(**key_counts(source, archive, pk).first().asDict())


def count_gates(source: DataFrame, archive: DataFrame, pk: tuple[str, ...], exported: Column) -> DataFrame:
    """The counts and the gates that must all hold before contents are compared."""
    return key_counts(source, archive, pk).select(
        "*",
        (F.col("archive_rows") == exported).alias("archive_holds_export"),
        (F.col("source_rows") == exported).alias("source_unchanged"),
        (F.col("duplicate_keys") == 0).alias("keys_unique"),
        ((F.col("missing_in_archive") == 0) & (F.col("missing_in_source") == 0)).alias("keys_equal"),
    )


def missing_in_archive(source: DataFrame, archive: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Source rows whose key the archive lacks; NULL keys match each other."""
    return by_membership(source, archive, pk, "left_anti", null_safe=True)


def missing_in_source(source: DataFrame, archive: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Archive rows whose key the source lacks; NULL keys match each other."""
    return by_membership(archive, source, pk, "left_anti", null_safe=True)


def diff(
    source: DataFrame,
    archive: DataFrame,
    pk: tuple[str, ...],
    profile: KeyProfile | None = None,
) -> DataFrame:
    """One row per key: the key, a verdict and the names of the columns that differ.

    Keys are counted first (key columns only). With unique keys, the normal
    case, the contents meet in one full outer join on the key. Keys held by
    several rows have no row-to-row pairing; they are reported once each as
    ``duplicate_key`` and kept out of the join, so no key can multiply rows
    or overload a task.
    """
    if not same_columns(source.schema, archive.schema):
        raise ValueError(
            f"column mismatch: source has {source.schema.simpleString()}, "
            f"archive has {archive.schema.simpleString()}"
        )
    profile = profile or key_profile(source, archive, pk)
    if profile.duplicate_keys == 0:
        return _compare(source, archive, pk)
    # Written once: both sides and the report read it.
    spark = source.sparkSession
    path = scratch_dir(spark, "repeated-keys")
    repeated = key_census(source, archive, pk).where("source_rows > 1 or archive_rows > 1").select(*[col(c) for c in pk])
    repeated.write.parquet(path)
    repeated = spark.read.schema(repeated.schema).parquet(path)
    single = [by_membership(side, repeated, pk, "left_anti", null_safe=True) for side in (source, archive)]
    reported = repeated.select(
        *[col(c) for c in pk],
        F.lit(DUPLICATE_KEY).alias("verdict"),
        F.array().cast("array<string>").alias("mismatch_columns"),
    )
    return _compare(*single, pk).unionByName(reported)


def first_mismatch(differences: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """The row of ``diff`` with the smallest key among those that do not match; no row where all match."""
    wrong = differences.where(F.col("verdict") != MATCH)
    first = F.min(F.struct(*[col(c) for c in pk], "verdict", "mismatch_columns")).alias("first")
    return wrong.agg(first).where("first IS NOT NULL").select("first.*")


def summarize(differences: DataFrame) -> DataFrame:
    return differences.groupBy("verdict").agg(F.count("*").alias("n_keys"))


def set_equality(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows only in one side, as multisets, both directions from one aggregation."""
    if not same_columns(left.schema, right.schema):
        raise ValueError("the two sides have different columns")
    columns = [col(c) for c in left.columns]
    signed = left.select(*columns, F.lit(1).alias("__side")).unionByName(
        right.select(*columns, F.lit(-1).alias("__side"))
    )
    excess = signed.groupBy(*columns).agg(F.sum("__side").alias("__excess"))
    return excess.agg(
        F.coalesce(F.sum(F.greatest(F.col("__excess"), F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("__excess"), F.lit(0))), F.lit(0)).alias("only_right"),
    )


def _compare(source: DataFrame, archive: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """Full outer join of two sides with unique keys; columns compared null-safely."""
    names = source.columns
    left, right = (
        side.select(*[col(c).alias(f"{tag}{i}") for i, c in enumerate(names)], F.lit(True).alias(tag))
        for tag, side in (("s", source), ("a", archive))
    )
    key_at = [names.index(c) for c in pk]
    on = F.lit(True)
    for i in key_at:
        on = on & F.col(f"s{i}").eqNullSafe(F.col(f"a{i}"))
    unequal = {
        c: ~F.col(f"s{i}").eqNullSafe(F.col(f"a{i}")) for i, c in enumerate(names) if i not in key_at
    }
    # The verdict stops at the first difference; names are listed for unequal rows only.
    differs = reduce(or_, unequal.values(), F.lit(False))
    changed = F.array_compact(
        F.array(*[F.when(test, F.lit(c)) for c, test in unequal.items()]).cast("array<string>")
    )
    in_both = F.col("s").isNotNull() & F.col("a").isNotNull()
    return left.join(right, on, "full_outer").select(
        *[F.when(F.col("s"), F.col(f"s{i}")).otherwise(F.col(f"a{i}")).alias(names[i]) for i in key_at],
        F.when(F.col("a").isNull(), MISSING_IN_ARCHIVE)
        .when(F.col("s").isNull(), MISSING_IN_SOURCE)
        .when(differs, MISMATCH)
        .otherwise(MATCH)
        .alias("verdict"),
        F.when(in_both & differs, changed)
        .otherwise(F.array().cast("array<string>"))
        .alias("mismatch_columns"),
    )
