from datetime import date

import pytest

from coldshelf import TableSpec, Window, plan_windows, resolve_window
from coldshelf.plans.windows import window_plan_counts

AS_OF = date(2026, 1, 15)
CUTOFF = date(2021, 1, 15)
SPEC = TableSpec("t", pk="id")


def dated(spark, *days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id bigint, fye date")


def test_explicit_start_is_taken_as_is(spark):
    found = resolve_window(dated(spark), SPEC, AS_OF, explicit_start=date(2018, 1, 15))
    assert found.eligible and found.window == Window(date(2018, 1, 15), date(2018, 5, 15))
    assert found.cutoff == CUTOFF


def test_end_is_clipped_at_the_cutoff(spark):
    found = resolve_window(dated(spark), SPEC, AS_OF, explicit_start=date(2020, 11, 15))
    assert found.window == Window(date(2020, 11, 15), CUTOFF)


def test_start_at_the_cutoff_is_not_eligible(spark):
    found = resolve_window(dated(spark), SPEC, AS_OF, explicit_start=CUTOFF)
    assert not found.eligible and found.window is None
    assert (found.window_start, found.window_end) == (CUTOFF, CUTOFF)


def test_watermark_comes_before_the_oldest_date(spark):
    rows = dated(spark, date(2010, 3, 1))
    found = resolve_window(rows, SPEC, AS_OF, watermark=date(2017, 1, 15))
    assert found.window.start == date(2017, 1, 15)


def test_oldest_date_is_the_fallback(spark):
    found = resolve_window(dated(spark, date(2017, 5, 5), date(2016, 2, 3), None), SPEC, AS_OF)
    assert found.window.start == date(2016, 2, 3)


def test_oldest_date_respects_the_predicate(spark):
    rows = dated(spark, date(2016, 2, 3), date(2017, 5, 5))
    assert resolve_window(rows, SPEC.with_predicate("id > 0"), AS_OF).window.start == date(2017, 5, 5)


def test_empty_table_is_not_eligible(spark):
    found = resolve_window(dated(spark), SPEC, AS_OF)
    assert not found.eligible and found.window_start == CUTOFF


def test_leap_day_falls_back_to_the_28th(spark):
    found = resolve_window(dated(spark), SPEC, date(2020, 2, 29), explicit_start=date(2010, 1, 1))
    assert found.cutoff == date(2015, 2, 28)


def test_a_start_clamped_once_stays_clamped(spark):
    plan = plan_windows(dated(spark, date(2015, 10, 31)), SPEC, date(2022, 1, 1))
    assert [w.start for w in plan] == [
        date(2015, 10, 31),
        date(2016, 2, 29),
        date(2016, 6, 29),
        date(2016, 10, 29),
    ]
    assert plan[-1].end == date(2017, 1, 1)


def test_plan_equals_repeated_runs(spark):
    rows = dated(spark, date(2012, 8, 31))
    plan = plan_windows(rows, SPEC, AS_OF, window_months=1)
    start, expected = None, []
    while True:
        found = resolve_window(rows, SPEC, AS_OF, watermark=start, window_months=1)
        if not found.eligible:
            break
        expected.append(found.window)
        start = found.window_end
    assert plan == expected and len(plan) > 90


def test_plan_of_an_empty_or_young_table_is_empty(spark):
    assert plan_windows(dated(spark), SPEC, AS_OF) == []
    assert plan_windows(dated(spark, date(2025, 1, 1)), SPEC, AS_OF) == []


def test_counts_include_empty_windows(spark):
    rows = dated(spark, date(2019, 1, 1), date(2019, 4, 30), date(2020, 1, 5), date(2024, 1, 1), None)
    counts = window_plan_counts(rows, SPEC, AS_OF).orderBy("window_start").collect()
    assert [r.n_rows for r in counts] == [2, 0, 0, 1, 0, 0, 0][: len(counts)]
    assert counts[-1].window_end == CUTOFF


def test_a_window_must_not_be_empty():
    with pytest.raises(ValueError):
        Window(date(2020, 1, 1), date(2020, 1, 1))
