import json
from datetime import date
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from coldshelf import CatalogTable, LiveTable, Ledger, Retention, RetentionError, RetentionRefused, Status, Window
from coldshelf.operators.export import read_archive
from coldshelf.plans.ledger import CARRIED, REPLACED, LedgerConflict, fold
from coldshelf.session import scratch_dir
from coldshelf.sources.archive import ArchiveSchemaError, archive_scan
from coldshelf.sources.live import declared_not_null, staged_writer
from coldshelf.sources.rowfiles import RowFiles
from fixtures import AS_OF, NEXT, OLD, SPEC, Shelf, order, order_rows, orders, stored


def without_window(rows, window=OLD):
    return [r for r in sorted(rows) if not window.start <= r[2] < window.end]


def test_archive_then_restore_brings_back_the_same_rows(spark):
    shelf = Shelf(spark)
    before = shelf.rows()
    done = shelf.archive()
    assert (done.status, done.exported, done.reconciled, done.deleted) == (Status.DELETED, 30, 30, 30)
    assert shelf.rows() == without_window(before) and len(shelf.rows()) == 20
    assert shelf.statuses() == ["STARTED", "EXPORTED", "RECONCILED", "RECONCILED", "DELETED"]
    assert shelf.ledger.watermark(SPEC.name) == OLD.end

    left = places(shelf)
    assert shelf.archive().seq == done.seq and places(shelf) == left

    files = shelf.files()
    assert done.n_files == len(files) == 3
    back = shelf.restore(files)
    assert (back.status, back.restored) == (Status.RESTORED, 30)
    assert shelf.rows() == before
    left = places(shelf)
    assert shelf.restore(files).seq == back.seq and places(shelf) == left

    with pytest.raises(RetentionRefused, match="was restored"):
        shelf.archive()
    assert shelf.archive(force=True).status is Status.DELETED
    assert shelf.ledger.superseded_files(SPEC.name).count() == 3
    with pytest.raises(RetentionRefused, match="later export"):
        shelf.restore(files)
    assert shelf.restore(shelf.files()).status is Status.RESTORED
    assert shelf.rows() == before


def test_restore_refuses_unknown_mixed_and_incomplete_files(spark):
    shelf = Shelf(spark)
    with pytest.raises(RetentionRefused, match="not recorded"):
        shelf.restore(["/tmp/nowhere/test_orders_run-x_token-y-00000.parquet"])
    with pytest.raises(RetentionRefused, match="no archive file"):
        shelf.restore([])
    assert len(shelf.rows()) == 50
    shelf.archive()
    shelf.archive(NEXT)
    old, following = shelf.files(), shelf.files(NEXT)
    with pytest.raises(RetentionRefused, match="different windows"):
        shelf.restore(old + following)
    assert shelf.status() is shelf.status(NEXT) is Status.DELETED
    some = old[1:]
    held = spark.read.parquet(*some).count()
    with pytest.raises(RetentionError, match=f"hold {held} rows, the window has 30"):
        shelf.restore(some)
    assert shelf.status() is Status.RESTORE_FAILED
    assert len(shelf.rows()) == 10
    assert shelf.restore(old).status is Status.RESTORED


def test_named_files_are_read_among_others(spark, tmp_path):
    """Files in folders with other files, spaces and signs in their names, given with a scheme or without."""
    folder = tmp_path / "cold store+1" / "a%20b [2]"
    rows = spark.range(40).repartition(4)
    rows.write.parquet(str(folder))
    names = sorted(p.name for p in folder.glob("*.parquet"))
    (folder / "deeper").mkdir()
    (folder / names[3]).rename(folder / "deeper" / names[3])
    given = [f"{folder}/{names[0]}", f"file:{folder}/{names[1]}", f"file://{folder}/deeper/{names[3]}"]
    want = {x for i in (0, 1, 3) for x in pq.read_table(folder / "deeper" / names[i] if i == 3 else folder / names[i]).column("id").to_pylist()}
    for files in (given, spark.createDataFrame([(g,) for g in given], "file_path string")):
        got = archive_scan(spark, files, rows.schema)
        assert sorted(r.id for r in got.collect()) == sorted(want) and got.columns == ["id"]
    with pytest.raises(ArchiveSchemaError, match="named 2 times"):
        archive_scan(spark, [given[0], "file:" + given[0]], rows.schema)


def test_files_may_have_moved(spark, tmp_path):
    import os
    import shutil

    shelf = Shelf(spark)
    before = shelf.rows()
    shelf.archive()
    moved = []
    for i, f in enumerate(shelf.files()):
        target = tmp_path / str(i) / os.path.basename(f)
        target.parent.mkdir()
        shutil.copy(f, target)
        moved.append(str(target))
    twice = [moved[0], *moved]
    with pytest.raises(RetentionError):
        shelf.restore(twice)
    assert shelf.restore(moved).status is Status.RESTORED
    assert shelf.rows() == before


def test_restore_refuses_a_window_with_rows(spark):
    shelf = Shelf(spark)
    shelf.archive()
    late = orders(spark, [order(77, OLD.start, "1.00")])
    shelf.table.insert(late, SPEC)
    with pytest.raises(RetentionRefused, match="already has 1 rows"):
        shelf.restore(shelf.files())
    assert shelf.status() is Status.DELETED


def test_dry_run_and_kill_switch_delete_nothing(spark):
    shelf = Shelf(spark)
    skipped = shelf.archive(dry_run=True)
    assert (skipped.status, skipped.error_message, skipped.reconciled) == (Status.DELETE_SKIPPED, "dry run: 30 rows would be deleted", 30)
    assert len(shelf.rows()) == 50
    assert shelf.archive().status is Status.DELETED

    off = Shelf(spark, delete_enabled=False)
    assert off.archive().status is Status.DELETE_SKIPPED
    assert len(off.rows()) == 50 and off.ledger.watermark(SPEC.name) is None


def test_null_in_a_required_column_fails_the_export(spark):
    rows = order_rows()
    rows[3] = rows[3][:3] + (None,) + rows[3][4:]
    shelf = Shelf(spark, rows)
    with pytest.raises(RetentionError, match="order_amount.*'order_id': 4"):
        shelf.archive()
    assert shelf.statuses() == ["STARTED", "EXPORT_FAILED"]
    assert "order_amount" in shelf.ledger.find(SPEC.name, OLD).error_message


def test_duplicate_keys_fail_reconcile(spark):
    shelf = Shelf(spark, order_rows() + [order(5, OLD.start, "9.00")])
    with pytest.raises(RetentionError, match="occur more than once"):
        shelf.archive()
    assert shelf.status() is Status.RECONCILE_FAILED and len(shelf.rows()) == 51


def test_a_changed_archive_file_fails_reconcile(spark):
    shelf = Shelf(spark)
    record = shelf.jobs.export_window(shelf.table, SPEC, OLD)
    changed = shelf.table.read().where("order_id <= 30").withColumn(
        "order_amount", F.when(F.col("order_id") == 7, F.lit("41.51")).otherwise("41.50").cast("decimal(12,2)")
    )
    folder = scratch_dir(spark, "forged")
    changed.withColumn("archive_key", F.lit("2015-01")).write.partitionBy("archive_key").parquet(folder)
    from dataclasses import replace

    with pytest.raises(RetentionError, match=r"mismatch at order_id=7, column\(s\) \['order_amount'\]"):
        shelf.jobs.reconcile_window(shelf.table, SPEC, OLD, record=replace(record, archive_path=folder))
    with pytest.raises(RetentionRefused, match="RECONCILE_FAILED"):
        shelf.jobs.delete_window(shelf.table, SPEC, OLD)
    assert len(shelf.rows()) == 50


def reconciled(shelf):
    shelf.jobs.export_window(shelf.table, shelf.spec, OLD)
    return shelf.jobs.reconcile_window(shelf.table, shelf.spec, OLD)


def test_drift_after_reconcile_stops_the_delete(spark):
    shelf = Shelf(spark)
    reconciled(shelf)
    # One row added and one removed: the count stays, the content does not.
    shelf.table.delete_window(SPEC.with_predicate("order_id = 3"), OLD, 1)
    shelf.table.insert(orders(spark, [order(99, OLD.start, "1.00")]), SPEC)
    with pytest.raises(RetentionError, match="missing_in"):
        shelf.jobs.delete_window(shelf.table, SPEC, OLD)
    assert shelf.status() is Status.DELETE_FAILED and len(shelf.rows()) == 50


def test_changes_outside_the_window_do_not_stop_the_delete(spark, monkeypatch):
    shelf = Shelf(spark)
    done = reconciled(shelf)
    monkeypatch.setattr(Retention, "_prove_equal", None)  # no second proof is made
    shelf.table.insert(orders(spark, [order(99, date(2016, 1, 1), "1.00")]), SPEC)
    assert shelf.table.state_of(OLD) == done.source_state
    assert shelf.jobs.delete_window(shelf.table, SPEC, OLD).deleted == 30
    assert len(shelf.rows()) == 21


def test_rows_next_to_the_window_lead_to_a_second_proof(spark):
    shelf = Shelf(spark)
    window = Window(date(2015, 1, 1), date(2015, 3, 15))
    shelf.jobs.export_window(shelf.table, SPEC, window)
    done = shelf.jobs.reconcile_window(shelf.table, SPEC, window)
    held = done.reconciled
    shelf.table.insert(orders(spark, [order(99, date(2015, 3, 20), "1.00")]), SPEC)
    assert shelf.table.state_of(window) != done.source_state
    assert shelf.jobs.delete_window(shelf.table, SPEC, window).deleted == held
    assert len(shelf.rows()) == 51 - held


def test_a_delete_whose_record_was_lost_is_finished(spark, monkeypatch):
    shelf = Shelf(spark)
    before = shelf.rows()
    reconciled(shelf)
    publish = CatalogTable.delete_window

    def dies_after(*given):
        publish(*given)
        raise KeyboardInterrupt

    monkeypatch.setattr(CatalogTable, "delete_window", dies_after)
    with pytest.raises(KeyboardInterrupt):
        shelf.jobs.delete_window(shelf.table, SPEC, OLD)
    monkeypatch.setattr(CatalogTable, "delete_window", publish)
    assert len(shelf.rows()) == 20 and shelf.status() is Status.RECONCILED
    done = shelf.archive()
    assert (done.status, done.deleted) == (Status.DELETED, 30)
    assert shelf.restore(shelf.files()).status is Status.RESTORED and shelf.rows() == before


def test_a_row_removed_by_its_owner_is_not_taken_for_a_begun_delete(spark):
    shelf = Shelf(spark)
    reconciled(shelf)
    shelf.table.delete_window(SPEC.with_predicate("order_id = 3"), OLD, 1)
    with pytest.raises(RetentionError, match="29 rows"):
        shelf.jobs.delete_window(shelf.table, SPEC, OLD)
    done = shelf.archive()
    assert (done.status, done.exported, done.deleted) == (Status.DELETED, 29, 29)
    shelf.restore(shelf.files())
    assert 3 not in [r[0] for r in shelf.rows()] and len(shelf.rows()) == 49


def test_a_table_filed_under_another_time_zone(spark):
    """Instants near midnight lie in periods of the neighbouring date."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = spark.sql("select id, timestamp'2015-01-01 02:00:00' + make_dt_interval(cast(id as int), 0, 0, 0) as fye from range(151)")
    root = scratch_dir(spark, "zone")
    spec = SPEC.__class__("zoned", pk="id")
    table = stored(spark, root, rows, spec)
    jobs = Retention(spark, Ledger(spark, f"{root}/ledger"), f"{root}/archive")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        done = [jobs.archive_window(table, spec, Window(date(2015, m, 1), date(2015, m + 1, 1)), AS_OF) for m in (1, 2, 3)]
        assert [(r.status, r.deleted) for r in done] == [(Status.DELETED, 31), (Status.DELETED, 28), (Status.DELETED, 31)]
        assert table.read().count() == 151 - 90
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_transform_that_drops_rows_is_refused(spark):
    shelf = Shelf(spark)
    with pytest.raises(RetentionError, match="29 rows of 30"):
        shelf.archive(transform=lambda df: df.where("order_id <> 15"))
    assert shelf.status() is Status.EXPORT_FAILED and len(shelf.rows()) == 50


def test_extra_predicate_is_part_of_the_window(spark):
    spec = SPEC.with_predicate("order_id <= 20 OR order_id = 35")
    shelf = Shelf(spark, spec=spec)
    before = shelf.rows()
    done = shelf.archive()
    assert done.deleted == 20 and len(shelf.rows()) == 30
    with pytest.raises(RetentionRefused, match="was archived with predicate"):
        shelf.jobs.archive_window(shelf.table, SPEC, OLD, AS_OF)
    # The restore does not need the predicate; the ledger remembers it.
    shelf.jobs.restore_files(shelf.table, SPEC, shelf.files())
    assert shelf.rows() == before


def test_young_windows_are_refused(spark):
    shelf = Shelf(spark)
    young = Window(date(2025, 9, 1), date(2026, 1, 1))
    with pytest.raises(RetentionRefused, match="retention cutoff"):
        shelf.archive(young)
    assert shelf.ledger.find(SPEC.name, young) is None
    assert shelf.archive(young, allow_young=True).status is Status.DELETED


def test_walk_passes_gaps_and_stops_at_the_cutoff(spark):
    rows = [order(1, date(2015, 1, 31), "1.00"), order(2, date(2016, 3, 1), "1.00"), order(3, date(2025, 1, 1), "1.00")]
    shelf = Shelf(spark, rows, window_months=9)
    done = shelf.jobs.archive_pending(shelf.table, SPEC, date(2021, 10, 1))
    assert [r.deleted for r in done] == [1, 1, 0]
    assert done[-1].window.end == date(2016, 10, 1)
    assert [r[0] for r in shelf.rows()] == [3]
    assert shelf.jobs.archive_next(shelf.table, SPEC, date(2021, 10, 1)) is None
    assert done[2].n_files == 0


def jobs_of(spark, work):
    """How many Spark jobs it takes."""
    group = f"walk-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_of_a_walk_do_not_grow_with_the_windows(spark):
    taken, shelves = [], []
    for months in (24, 3, 1):
        shelf = Shelf(spark, window_months=months)
        taken.append(jobs_of(spark, lambda: shelves.append((shelf, shelf.jobs.archive_pending(shelf.table, SPEC, date(2024, 1, 1))))))
    assert [len(done) for _, done in shelves] == [2, 16, 48]
    assert taken[0] == taken[1] == taken[2], taken
    for shelf, done in shelves:
        assert [r[0] for r in shelf.rows()] == list(range(41, 51))
        assert sum(r.deleted for r in done) == 40 and {r.status for r in done} == {Status.DELETED}
        assert all(a.window.end == b.window.start for a, b in zip(done, done[1:]))
        assert shelf.statuses(done[0].window) == ["STARTED", "EXPORTED", "RECONCILED", "RECONCILED", "DELETED"]


def test_windows_of_a_walk_are_restored_one_by_one(spark):
    shelf = Shelf(spark, window_months=1)
    before = shelf.rows()
    done = shelf.jobs.archive_pending(shelf.table, SPEC, date(2024, 1, 1))
    names = [f.rsplit("/", 1)[1] for r in done for f in set(shelf.files(r.window))]
    assert len(set(names)) == len(names)
    held = [r for r in done if r.n_files]
    assert all(len(shelf.files(r.window)) == r.n_files for r in (*held, done[-1])) and len(held) > 4
    for record in held:
        assert shelf.restore(shelf.files(record.window)).restored == record.deleted
    assert shelf.rows() == before


def test_a_walk_stops_at_the_first_window_with_a_fault(spark):
    """The windows before it are archived, as if each had been walked to by itself."""
    rows = order_rows()
    rows[33] = (*rows[33][:1], None, *rows[33][2:])
    shelf = Shelf(spark, rows)
    with pytest.raises(RetentionError, match="customer_id"):
        shelf.jobs.archive_pending(shelf.table, SPEC, date(2024, 1, 1))
    assert shelf.status(OLD) is Status.DELETED and shelf.status(NEXT) is Status.EXPORT_FAILED
    assert len(shelf.rows()) == 20


def test_a_walk_cut_short_in_its_delete_is_finished(spark):
    live = Live(spark)
    stop = Path(live.store.folder.removeprefix("file:")).parent / "stop"
    stop.touch()
    delete = live.store.delete_rows

    def lost(archived):
        if stop.exists() and max(archived.column("order_id").to_pylist()) > 25:
            raise ConnectionError("lost")
        return delete(archived)

    object.__setattr__(live.table, "delete_rows", lost)
    live.jobs = Retention(spark, live.jobs.ledger, live.jobs.archive_root, window_months=2)
    before, as_of = live.rows(), date(2020, 9, 1)
    with pytest.raises(RetentionError, match="lost"):
        live.jobs.archive_pending(live.table, SPEC, as_of)
    assert 10 < len(live.rows()) < 50
    stop.unlink()
    live.jobs.archive_pending(live.table, SPEC, as_of)
    assert [r[0] for r in live.rows()] == list(range(41, 51))
    files = live.jobs.ledger.state(SPEC.name).where("deleted > 0").select("archive_path").collect()
    schema = live.schema
    held = [tuple(r) for f in files for r in read_archive(spark, f.archive_path, schema).drop("archive_key").collect()]
    assert sorted(held + live.rows()) == before


def test_a_walk_with_a_transform_or_predicate(spark):
    shelf = Shelf(spark, window_months=2)
    spec = SPEC.with_predicate("order_id % 2 = 0")
    done = shelf.jobs.archive_pending(shelf.table, spec, date(2024, 1, 1), transform=lambda rows: rows.withColumn("status", F.lower("status")))
    assert sum(r.deleted for r in done) == 20 and all(r.transformed and r.predicate for r in done)
    assert [r[0] for r in shelf.rows()] == [*range(1, 41, 2), *range(41, 51)]


def test_a_window_that_only_touches_periods_is_empty(spark):
    shelf = Shelf(spark, [order(1, date(2015, 1, 31), "1.00")])
    done = shelf.archive(Window(date(2015, 1, 1), date(2015, 1, 15)))
    assert (done.status, done.exported, done.n_files, done.deleted) == (Status.DELETED, 0, 0, 0)
    assert len(shelf.rows()) == 1


def test_walk_skips_a_restored_window(spark):
    rows = [order(1, date(2015, 1, 1), "1.00"), order(2, date(2015, 6, 1), "1.00")]
    shelf = Shelf(spark, rows)
    as_of = date(2020, 9, 1)
    first = shelf.jobs.archive_next(shelf.table, SPEC, as_of)
    shelf.restore(shelf.files(first.window))
    done = shelf.jobs.archive_pending(shelf.table, SPEC, as_of)
    assert [r.window.start for r in done] == [date(2015, 5, 1)]
    assert [r[0] for r in shelf.rows()] == [1]


def test_transformed_windows_cannot_be_restored(spark):
    shelf = Shelf(spark)
    done = shelf.archive(transform=lambda df: df.withColumn("status", F.lower("status")))
    assert done.status is Status.DELETED and done.transformed
    with pytest.raises(RetentionRefused, match="transform"):
        shelf.restore(shelf.files())
    with pytest.raises(RetentionError, match="must keep column 'order_id'"):
        shelf.archive(NEXT, transform=lambda df: df.withColumn("order_id", F.col("order_id").cast("string")))


def test_columns_added_since_the_export(spark):
    shelf = Shelf(spark)
    shelf.archive()
    shelf.table.add_columns([T.StructField("note", T.StringType())])
    with pytest.raises(RetentionError, match="lacks column"):
        shelf.restore(shelf.files())
    shelf.restore(shelf.files(), allow_missing_columns=True)
    assert shelf.table.read().where("note is null").count() == 50


def test_small_integers_come_back_small(spark):
    root = scratch_dir(spark, "small")
    spec = SPEC.__class__("small_ints", pk="id")
    rows = spark.sql("select cast(id as tinyint) id, date'2015-01-05' fye, cast(id as smallint) s from range(5)")
    table = stored(spark, root, rows, spec)
    jobs = Retention(spark, Ledger(spark, f"{root}/ledger"), f"{root}/archive")
    record = jobs.archive_window(table, spec, OLD, AS_OF)
    files = [r.file_path for r in jobs.ledger.output_files(spec.name, OLD).collect()]
    assert record.deleted == 5 and table.read().count() == 0
    jobs.restore_files(table, spec, files)
    assert table.read().dtypes == rows.dtypes
    assert table.read().exceptAll(rows).count() == 0


# -- ledger and tables -------------------------------------------------------


def test_ledger_carries_counts_and_replaces_errors(spark):
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    assert ledger.find("t", OLD) is None and ledger.watermark("t") is None
    ledger.record("t", OLD, Status.STARTED, "a")
    ledger.record("t", OLD, Status.EXPORTED, "a", exported=5, n_files=2, export_run="a")
    ledger.record("t", OLD, Status.RECONCILE_FAILED, "a", error="x" * 2500)
    failed = ledger.find("t", OLD)
    assert (failed.exported, failed.n_files, len(failed.error_message)) == (5, 2, 2500)
    again = ledger.record("t", OLD, Status.STARTED, "b")
    assert (again.exported, again.export_run, again.error_message) == (5, "a", None)
    assert ledger.find("t", OLD) == again.__class__(**{**again.__dict__, "at": ledger.find("t", OLD).at})
    ledger.record("other", OLD, Status.STARTED, "c")
    assert ledger.state("t").count() == 1 and ledger.state().count() == 2


def test_statuses_must_follow_each_other(spark):
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    for status in Status:
        if status is not Status.STARTED:
            with pytest.raises(LedgerConflict):
                ledger.record("t", OLD, status, "a")
    started = ledger.record("t", OLD, Status.STARTED, "a")
    with pytest.raises(LedgerConflict, match="DELETED may not follow STARTED"):
        ledger.record("t", OLD, Status.DELETED, "a", after=started)
    ledger.record("t", OLD, Status.EXPORTED, "a", after=started)
    # A stale state: its number is taken, the true state is looked up instead.
    with pytest.raises(LedgerConflict, match="EXPORT_FAILED may not follow EXPORTED"):
        ledger.record("t", OLD, Status.EXPORT_FAILED, "a", after=started)


def test_an_event_folder_without_an_event_is_skipped(spark, tmp_path):
    root = tmp_path / "ledger"
    ledger = Ledger(spark, str(root))
    ledger.record("t", OLD, Status.STARTED, "a")
    (root / "events" / "t=t" / "seq=2").mkdir()
    assert ledger.record("t", OLD, Status.EXPORTED, "a").seq == 3
    assert ledger.find("t", OLD).status is Status.EXPORTED


def test_a_lookup_reads_few_files_however_long_the_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Ledger, "COMPACT", 5)
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    windows = [Window(date(2010 + i, 1, 1), date(2011 + i, 1, 1)) for i in range(3)]
    read = []
    for i in range(3 * Ledger.COMPACT + 5):
        window = windows[i % 2]
        known = ledger.find("t", window)
        status = Status.EXPORTED if known and known.status is Status.STARTED else Status.STARTED
        ledger.record("t", window, status, f"run{i}", **({"exported": i} if status is Status.EXPORTED else {}))
        read.append(len(ledger.state("t").inputFiles()))
    assert max(read) <= Ledger.COMPACT + 4 and len(ledger.events("t").inputFiles()) > 3 * Ledger.COMPACT
    whole = fold(ledger.events("t"), CARRIED, REPLACED)
    rows = [sorted(map(tuple, f.select(*sorted(f.columns)).collect()), key=repr) for f in (ledger.state("t"), whole)]
    assert rows[0] == rows[1] and len(rows[0]) == 2
    steps = ledger.record_many("t", {w: ledger.find("t", w) for w in windows}, Status.STARTED, "run", None)
    assert {ledger.find("t", w) == steps[w] or ledger.find("t", w).seq == steps[w].seq for w in windows} == {True}


def test_a_state_that_was_not_written_to_its_end_is_not_used(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    for i in range(Ledger.COMPACT + 1):
        ledger.record("t", OLD, Status.STARTED, f"run{i}")
    (tmp_path / "ledger" / "state" / "t=t" / f"upto={Ledger.COMPACT}" / "_SUCCESS").unlink()
    assert ledger.find("t", OLD).run_token == f"run{Ledger.COMPACT}"
    assert ledger.find("t", OLD).seq == Ledger.COMPACT + 1


def places(shelf):
    """The folder of each of the table's periods."""
    found = {}
    for period in shelf.table.periods():
        rows = shelf.table.spark.table(shelf.table.name).where(F.col("period") == period)
        [row] = rows.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("f")).distinct().collect()
        found[period] = row.f
    return found


def test_whole_periods_are_dropped_without_a_rewrite(spark):
    shelf = Shelf(spark)
    before, left = places(shelf), shelf.table.state_of(NEXT)
    mid = Window(date(2015, 1, 10), date(2015, 3, 1))
    seen = shelf.table.state_of(mid)
    assert shelf.table.delete_window(SPEC, mid, 17) == 17
    after = places(shelf)
    assert {p for p in after if after[p] != before[p]} == {"2015-01"} and set(before) - set(after) == {"2015-02"}
    assert len(shelf.rows()) == 33
    with pytest.raises(ValueError, match="would delete"):
        shelf.table.delete_window(SPEC, NEXT, 3)
    assert places(shelf) == after and shelf.table.state_of(NEXT) == left and shelf.table.state_of(mid) != seen


def test_an_insert_moves_only_the_periods_it_adds_to(spark):
    shelf = Shelf(spark)
    before, held = places(shelf), shelf.rows()
    more = [order(90, date(2015, 1, 31), "1.00"), order(91, date(2020, 1, 1), "1.00"), order(92, date(2020, 1, 2), "1.00")]
    assert shelf.table.insert(orders(spark, more), SPEC) == 3
    after = places(shelf)
    assert {p for p in after if after[p] != before.get(p)} == {"2015-01", "2020-01"} and set(before) < set(after)
    assert shelf.rows() == sorted(held + more)
    with pytest.raises(ValueError, match="table's columns"):
        shelf.table.insert(orders(spark, more).drop("status"), SPEC)
    assert shelf.table.insert(orders(spark, []), SPEC) == 0 and places(shelf) == after


def test_rows_without_a_date_stay(spark):
    rows = [order(1, date(2015, 1, 2), "1.00"), order(2, date(2015, 1, 3), "1.00")[:2] + (None,) + order(3, OLD.start, "2.00")[3:]]
    shelf = Shelf(spark, rows)
    assert sorted(shelf.table.periods()) == ["2015-01", "unknown"]
    assert shelf.archive().deleted == 1
    assert shelf.table.periods() == ["unknown"] and [r[0] for r in shelf.rows()] == [2]
    assert shelf.table.read(Window(date(1, 1, 1), date(9999, 1, 1))).count() == 0


def test_a_managed_table_and_its_declared_columns(spark):
    """Without a location the table is Spark's own: what a dropped period held is deleted."""
    rows = spark.sql("select id, date'2015-01-01' + cast(id as int) as fye, 'it''s' as `a b` from range(90)")
    name = f"managed_{scratch_dir(spark, 'x')[-12:]}"
    spec = SPEC.__class__(name, pk="id")
    table = CatalogTable.create(spark, name, rows, spec)
    try:
        assert [f.name for f in table.schema().fields if not f.nullable] == ["id", "fye", "a b"]
        folder = spark.sql(f"describe table extended {name}").where("col_name = 'Location'").first().data_type
        assert table.delete_window(spec, Window(date(2015, 2, 1), date(2015, 3, 15)), 42) == 42
        assert table.read().count() == 48 and sorted(table.periods()) == ["2015-01", "2015-03"]
        assert not Path(folder.removeprefix("file:"), "period=2015-02").exists()
        with pytest.raises(ValueError, match="own"):
            CatalogTable.create(spark, name, rows.withColumn("Period", F.lit(1)), spec)
    finally:
        spark.sql(f"drop table {name}")


# -- a table outside Spark ------------------------------------------------------


class Live:
    """Orders kept in one file each, with the jobs over them; ``on_read`` runs before each read of the table."""

    def __init__(self, spark, rows=None, **options):
        root = scratch_dir(spark, "live")
        self.spark, self.schema = spark, orders(spark, []).schema
        self.store = RowFiles(f"{root}/rows", "order_id", self.schema)
        self.store.fill(orders(spark, rows))
        self.reads, self.on_read = 0, None
        options = {"delete_rows": self.store.delete_rows, "writer": self.store.fill, "delete_batch_rows": 7, **options}
        self.table = LiveTable(self.read, **options)
        self.jobs = Retention(spark, Ledger(spark, f"{root}/ledger"), f"{root}/archive")

    def read(self):
        if self.on_read:
            self.on_read(self.reads)
        self.reads += 1
        return orders(self.spark, self.rows())

    def rows(self):
        return sorted(tuple(r) for r in self.store.read(self.spark).collect())

    def archived(self, window=OLD):
        record = self.jobs.ledger.find(SPEC.name, window)
        schema = T.StructType.fromJson(json.loads(record.archive_schema))
        return sorted(tuple(r) for r in read_archive(self.spark, record.archive_path, schema).drop("archive_key").collect())

    def archive(self, spec=SPEC, **options):
        return self.jobs.archive_window(self.table, spec, OLD, AS_OF, **options)


def test_live_table_is_deleted_by_archived_rows(spark):
    live = Live(spark)
    before = live.rows()
    assert live.archive().deleted == 30 and live.rows() == without_window(before)
    files = [r.file_path for r in live.jobs.ledger.output_files(SPEC.name, OLD).collect()]
    assert live.jobs.restore_files(live.table, SPEC, files).restored == 30
    assert live.rows() == before


def test_a_folder_of_rows_has_few_files_and_keeps_each_write(spark):
    live = Live(spark, [order(i, OLD.start, "1.00") for i in range(3000)])
    folder = Path(live.store.folder.removeprefix("file:"))
    assert len([f for f in folder.rglob("*") if f.is_file()]) < 10
    assert [r[0] for r in live.rows()] == list(range(3000))
    # A fill replaces rows that are there, two batches of one page do not undo each other, a batch may come twice.
    live.store.fill(orders(spark, [order(i, OLD.start, "2.00") for i in (-1, 5, 2999)]))
    assert live.store.get(5)["order_amount"] == Decimal("2.00") and len(live.rows()) == 3001
    rows = orders(spark, [order(i, OLD.start, "1.00") for i in (3, 4, 5, 9999)]).toArrow()
    assert [live.store.delete_rows(rows) for _ in range(2)] == [1, 1]
    assert live.store.delete_rows(orders(spark, [order(6, OLD.start, "1.00")]).toArrow()) == 0
    assert [live.store.get(i) for i in (3, 4, 6)] == [None] * 3
    live.store.put({**live.store.get(7), "customer_id": 1})
    live.store.remove(8)
    assert [r[0] for r in live.rows()] == [-1, 0, 1, 2, 5, 7, *range(9, 3000)]


def test_live_delete_cut_short_is_finished(spark):
    live = Live(spark)
    refuse = Path(live.store.folder.removeprefix("file:")).parent / "refuse"
    refuse.touch()
    delete = live.store.delete_rows

    def lost(archived):
        if refuse.exists() and 17 in archived.column("order_id").to_pylist():
            raise ConnectionError("lost")
        return delete(archived)

    object.__setattr__(live.table, "delete_rows", lost)
    with pytest.raises(RetentionError, match="lost"):
        live.archive()
    assert 20 < len(live.rows()) < 50
    refuse.unlink()
    done = live.archive()
    assert (done.status, done.deleted, len(live.rows())) == (Status.DELETED, 30, 20)
    assert done.exported == 30 and live.jobs.ledger.output_files(SPEC.name, OLD).agg(F.sum("n_rows")).first()[0] == 30


def test_live_delete_with_a_predicate_takes_its_rows_only(spark):
    live = Live(spark)
    assert live.archive(SPEC.with_predicate("order_id in (1, 20)")).deleted == 2
    assert [r[0] for r in live.rows()] == [i for i in range(1, 51) if i not in (1, 20)]


def test_live_delete_after_a_transform_goes_by_key(spark):
    live = Live(spark)
    done = live.archive(transform=lambda rows: rows.withColumn("status", F.lower("status")))
    assert done.deleted == 30 and len(live.rows()) == 20
    assert {r[4] for r in live.archived()} == {"closed"}


@pytest.mark.parametrize("kind,at", [*(("swap", i) for i in range(8)), *(("change", i) for i in range(2, 7)), ("add", 4), ("add", 6)])
def test_no_row_is_lost_when_the_owner_writes_at_any_read(spark, kind, at):
    """Row 5 is replaced by row 777, or changed, or row 777 is added, before one of the reads."""
    live = Live(spark)
    fifth = live.store.get(5)
    new = {**fifth, "customer_id": 1, **({} if kind == "change" else {"order_id": 777})}

    def write(read):
        if read == at:
            if kind == "swap":
                live.store.remove(5)
            live.store.put(new)

    live.on_read = write
    try:
        status = live.archive().status
    except RetentionError:
        status = live.jobs.ledger.find(SPEC.name, OLD).status
    live.on_read = None
    last = tuple(new[c] for c in live.schema.names)
    left = live.rows()
    if live.reads > at:
        assert last in left or last in live.archived()
    others = [r for r in map(tuple, order_rows()) if r[0] != 5]
    assert all(r in left or r in live.archived() for r in others)
    if status is Status.DELETED:
        assert left == without_window(left)


def test_live_delete_leaves_what_came_after_the_proof(spark):
    live = Live(spark)
    fifth = live.store.get(5)

    class Swapped(LiveTable):
        def delete_window(self, *given):
            live.store.remove(5)
            live.store.put({**fifth, "order_id": 777})
            live.store.put({**live.store.get(6), "customer_id": 1})
            return super().delete_window(*given)

    table = Swapped(live.read, live.store.delete_rows, None, delete_batch_rows=7)
    with pytest.raises(RetentionError, match="1 archived key.* 29 are gone"):
        live.jobs.archive_window(table, SPEC, OLD, AS_OF)
    assert [r[0] for r in live.rows() if OLD.start <= r[2] < OLD.end] == [6, 777]
    assert live.jobs.ledger.find(SPEC.name, OLD).status is Status.DELETE_FAILED
    with pytest.raises(RetentionRefused, match="not in its files"):
        live.archive()


def cut_short_restore(live, keep=lambda key: True):
    """An archived window whose restore inserted rows and then ended."""
    live.archive()
    record = live.jobs.ledger.find(SPEC.name, OLD)
    live.jobs.ledger.record(SPEC.name, OLD, Status.RESTORE_STARTED, record.run_token, after=record)
    rows = [r for r in live.archived() if keep(r[0])]
    live.store.fill(orders(live.spark, rows))
    files = [r.file_path for r in live.jobs.ledger.output_files(SPEC.name, OLD).collect()]
    return lambda: live.jobs.restore_files(live.table, SPEC, files)


def test_a_restore_cut_short_after_its_insert_is_recorded(spark):
    live = Live(spark)
    before = live.rows()
    done = cut_short_restore(live)()
    assert (done.status, done.restored) == (Status.RESTORED, 30) and live.rows() == before


def test_a_partly_present_or_changed_window_is_not_taken_for_restored(spark):
    live = Live(spark)
    again = cut_short_restore(live, lambda key: key != 9)
    with pytest.raises(RetentionRefused, match="already has 29 rows"):
        again()
    live.store.put({**live.store.get(8), "order_id": 9})
    with pytest.raises(RetentionRefused, match="already has 30 rows"):
        again()
    assert live.jobs.ledger.find(SPEC.name, OLD).status is Status.RESTORE_STARTED


def test_a_restore_that_failed_after_its_insert_can_be_recorded(spark):
    live = Live(spark)
    again = cut_short_restore(live)
    record = live.jobs.ledger.find(SPEC.name, OLD)
    live.jobs.ledger.record(SPEC.name, OLD, Status.RESTORE_FAILED, record.run_token, after=record, error="lost")
    assert again().status is Status.RESTORED


def test_rows_of_a_deleted_window_are_still_refused(spark):
    """Without a restore that had begun, equal rows are somebody else's."""
    live = Live(spark)
    live.archive()
    live.store.fill(orders(spark, live.archived()))
    files = [r.file_path for r in live.jobs.ledger.output_files(SPEC.name, OLD).collect()]
    with pytest.raises(RetentionRefused, match="already has 30 rows"):
        live.jobs.restore_files(live.table, SPEC, files)


def test_staged_insert_is_parallel_and_published_once(spark, tmp_path):
    held, published = {}, []

    def fill(rows, staging):
        assert staging not in held
        held[staging] = rows.rdd.getNumPartitions()

    write = staged_writer(fill, published.append, 'shop."orders"')
    rows = orders(spark).repartition(5)
    write(rows)
    write(rows)
    assert published == list(held) and len(held) == 2 and set(held.values()) == {5}
    assert all(name.startswith("shop.orders_") for name in published)

    def fails(rows, staging):
        raise ConnectionError("lost")

    with pytest.raises(ConnectionError):
        staged_writer(fails, published.append, "orders")(rows)
    assert len(published) == 2


def catalog(spark):
    data = [
        ("db", "shop", "orders", "id", "NO", 1),
        ("db", "shop", "orders", "note", "YES", 2),
        ("db", "shop", "orders", "day", "NO", 3),
        ("db", "old", "orders", "key", "NO", 1),
        ("db", "shop", "Lines", "a", "NO", 1),
        ("db", "shop", "lines", "b", "NO", 1),
        ("db", "shop", "free", "c", "YES", 1),
    ]
    return spark.createDataFrame(
        data,
        "TABLE_CATALOG string, TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, IS_NULLABLE string, ORDINAL_POSITION int",
    )


@pytest.mark.parametrize(
    "name,columns",
    [
        ("shop.orders", ("id", "day")),
        ("SHOP.Orders", ("id", "day")),
        ('db."shop".`orders`', ("id", "day")),
        ("old.orders", ("key",)),
        ("shop.Lines", ("a",)),
        ("lines", ("b",)),
        ("free", ()),
    ],
)
def test_not_null_columns_of_a_qualified_table(spark, name, columns):
    assert declared_not_null(catalog(spark), name) == columns


@pytest.mark.parametrize("name", ["orders", "shop.LINES", "none", "other.orders", "(select 1) t", "a.b.c.d", ""])
def test_unclear_tables_are_an_error(spark, name):
    with pytest.raises(ValueError):
        declared_not_null(catalog(spark), name)


def test_declared_not_null_columns_are_required(spark):
    live = Live(spark, not_null=("status",))
    live.store.put({**live.store.get(3), "status": None})
    with pytest.raises(RetentionError, match="status.*'order_id': 3"):
        live.archive(SPEC.__class__("test_orders", pk="order_id"))


def test_jdbc_read_options():
    from coldshelf.sources.live import jdbc_options

    options = jdbc_options("jdbc:mariadb://db/app", "orders", "id", 1, 1000, 8)
    assert (options["partitionColumn"], options["numPartitions"], options["fetchsize"]) == ("id", "8", "1000")
    assert options["preferTimestampNTZ"] == "true"


def test_oldest_part_holds_the_oldest_date(spark):
    shelf = Shelf(spark)
    assert {r.fye.month for r in shelf.table.oldest_part(SPEC).select("fye").collect()} == {1}
    late = SPEC.with_predicate("order_id > 35")
    assert shelf.jobs.next_window(shelf.table, late, AS_OF).window_start == date(2015, 5, 26)
    assert shelf.jobs.next_window(shelf.table, SPEC, AS_OF).window_start == OLD.start
