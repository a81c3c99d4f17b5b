"""Semi and anti joins on a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from coldshelf.functions.columns import col


def same_key(pk: tuple[str, ...], tag: str = "k", null_safe: bool = True) -> Column:
    """``pk`` columns of one side equal to the ``<tag><i>`` columns of the other."""
    condition = F.lit(True)
    for i, c in enumerate(pk):
        other = F.col(f"{tag}{i}")
        condition = condition & (col(c).eqNullSafe(other) if null_safe else col(c) == other)
    return condition


def by_membership(
    rows: DataFrame, members: DataFrame, pk: tuple[str, ...], how: str, null_safe: bool
) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of rows with the keys of ``members``.

    One plain join: each side is shuffled once, or the keys are broadcast where
    Spark finds them small. Adaptive execution splits what one key holds too
    much of on the left side; of ``members`` only key columns are read.
    """
    keys = members.select(*[col(c).alias(f"k{i}") for i, c in enumerate(pk)])
    return rows.join(keys, same_key(pk, "k", null_safe), how)
