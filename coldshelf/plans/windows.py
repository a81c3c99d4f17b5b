"""Which window comes next, and all windows up to the retention cutoff."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coldshelf.functions.columns import col, require_date
from coldshelf.sources.scan import oldest_date
from coldshelf.spec import DEFAULTS, TableSpec, Window


@dataclass(frozen=True)
class ResolvedWindow:
    window_start: date | None
    window_end: date | None
    cutoff: date
    eligible: bool

    @property
    def window(self) -> Window | None:
        return Window(self.window_start, self.window_end) if self.eligible else None


def cutoff_date(as_of: date, retention_years: int) -> Column:
    """``as_of`` minus the retention; 29 February falls back to the 28th."""
    return F.add_months(F.lit(as_of), -12 * retention_years)


def resolved_window(
    table: DataFrame,
    spec: TableSpec,
    as_of: date,
    explicit_start: date | None = None,
    watermark: DataFrame | None = None,
    retention_years: int = DEFAULTS.retention_years,
    window_months: int = DEFAULTS.window_months,
) -> DataFrame:
    """The next window as one row: explicit start, else watermark, else oldest date.

    ``watermark`` is a one-row frame with a ``watermark`` date. An ineligible
    window (no start, or a start at or past the cutoff) is empty. With an explicit
    start the table is not read; else its oldest date is.
    """
    cutoff = cutoff_date(as_of, retention_years)
    candidates: list[Column] = []
    if explicit_start is not None:
        base = table.sparkSession.range(1).select(F.lit(explicit_start).alias("start"))
    else:
        if watermark is not None:
            candidates.append(watermark.select("watermark").scalar())
        base = oldest_date(table, spec).select(F.coalesce(*candidates, F.col("oldest")).alias("start"))
    eligible = F.coalesce(F.col("start") < cutoff, F.lit(False))
    end = F.least(F.add_months("start", window_months), cutoff)
    return base.select(
        F.coalesce("start", cutoff).alias("window_start"),
        F.when(eligible, end).otherwise(F.coalesce("start", cutoff)).alias("window_end"),
        cutoff.alias("cutoff"),
        eligible.alias("eligible"),
    )


def resolve_window(
    table: DataFrame,
    spec: TableSpec,
    as_of: date,
    explicit_start: date | None = None,
    watermark: date | None = None,
    retention_years: int = DEFAULTS.retention_years,
    window_months: int = DEFAULTS.window_months,
) -> ResolvedWindow:
    """The next window as a value; a known start or watermark spares the table scan."""
    frame = resolved_window(
        table, spec, as_of, explicit_start or watermark, None, retention_years, window_months
    )
    return ResolvedWindow(**frame.first().asDict())


def _starts(first: Column, cutoff: Column, window_months: int) -> Column:
    """Starts of all windows before the cutoff, oldest first.

    Each start is the previous end, as repeated runs would have it: a start on
    the 31st that was clamped once stays clamped, which ``first + k * months``
    would miss.
    """
    steps = F.ceil(F.months_between(cutoff, first) / window_months).cast("int") + 1

    def extend(known: Column, _: Column) -> Column:
        following = F.add_months(F.element_at(known, -1), window_months)
        return F.when(following < cutoff, F.array_append(known, following)).otherwise(known)

    return F.when(first < cutoff, F.aggregate(F.sequence(F.lit(1), steps), F.array(first), extend))


def window_plan(
    table: DataFrame,
    spec: TableSpec,
    as_of: date,
    retention_years: int = DEFAULTS.retention_years,
    window_months: int = DEFAULTS.window_months,
) -> DataFrame:
    """All windows from the oldest date up to the cutoff, one row each."""
    cutoff = cutoff_date(as_of, retention_years)
    starts = oldest_date(table, spec).select(
        F.explode(_starts(F.col("oldest"), cutoff, window_months)).alias("window_start")
    )
    return _with_ends(starts, cutoff, window_months)


def _with_ends(starts: DataFrame, cutoff: Column, window_months: int) -> DataFrame:
    return starts.select(
        "window_start",
        F.least(F.add_months("window_start", window_months), cutoff).alias("window_end"),
    )


def windows_between(spark: SparkSession, first: date, cutoff: date, window_months: int) -> list[Window]:
    """All windows from a start up to the cutoff, as repeated runs would have them."""
    starts = _starts(F.lit(first), F.lit(cutoff), window_months)
    plan = _with_ends(spark.range(1).select(F.explode(starts).alias("window_start")), F.lit(cutoff), window_months)
    return [Window(r.window_start, r.window_end) for r in plan.orderBy("window_start").collect()]


def window_plan_counts(
    table: DataFrame,
    spec: TableSpec,
    as_of: date,
    retention_years: int = DEFAULTS.retention_years,
    window_months: int = DEFAULTS.window_months,
) -> DataFrame:
    """Rows per planned window, empty windows included.

    Rows older than the cutoff are counted per calendar date, in one scan. What
    is left is one list of dates and counts, as long as the calendar and not the
    table; the plan begins at the oldest of them and adds them up by window.
    """
    kind = require_date(table.schema, spec.date_col)
    cutoff = cutoff_date(as_of, retention_years)
    rows = table.where(F.expr(f"({spec.predicate})")) if spec.predicate else table
    daily = (
        rows.where(col(spec.date_col) < cutoff.cast(kind))
        .groupBy(F.to_date(col(spec.date_col)).alias("day"))
        .agg(F.count("*").alias("n"))
    )
    days = daily.agg(F.collect_list(F.struct("day", "n")).alias("days"))
    starts = _starts(F.array_min(F.col("days.day")), cutoff, window_months)
    plan = days.select("days", F.explode(starts).alias("window_start")).select(
        "days", "window_start", F.least(F.add_months("window_start", window_months), cutoff).alias("window_end")
    )
    inside = F.filter("days", lambda d: (d["day"] >= F.col("window_start")) & (d["day"] < F.col("window_end")))
    total = F.aggregate(inside, F.lit(0).cast("long"), lambda n, d: n + d["n"])
    return plan.select("window_start", "window_end", total.alias("n_rows"))


def plan_windows(
    table: DataFrame,
    spec: TableSpec,
    as_of: date,
    retention_years: int = DEFAULTS.retention_years,
    window_months: int = DEFAULTS.window_months,
) -> list[Window]:
    """The planned windows as values; their number depends on the calendar, not on the rows."""
    plan = window_plan(table, spec, as_of, retention_years, window_months)
    return [Window(r.window_start, r.window_end) for r in plan.orderBy("window_start").collect()]
