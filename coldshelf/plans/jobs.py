"""The jobs a user calls: archive a window, walk all windows, restore files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from coldshelf.operators.export import (
    KEY,
    archive_rows,
    file_stem,
    manifest,
    read_archive,
    refuse_lost_rows,
    safe_name,
    write_archive,
)
from coldshelf.operators.reconcile import (
    MATCH,
    MISSING_IN_SOURCE,
    KeyProfile,
    diff,
    first_mismatch,
    key_profile,
    key_totals,
    set_equality,
)
from coldshelf.operators.restore import resolve_files, restore_union
from coldshelf.plans.ledger import Ledger, Record, Status
from coldshelf.plans.tabletypes import as_source, with_declared
from coldshelf.plans.walk import archive_together
from coldshelf.plans.windows import ResolvedWindow, resolve_window, windows_between
from coldshelf.sources.archive import archive_scan, named_files
from coldshelf.sources.scan import window_count, window_scan
from coldshelf.spec import DEFAULTS, TableSpec, Window, archive_schema, quoted, same_columns

Transform = Callable[[DataFrame], DataFrame]


class RetentionError(RuntimeError):
    """A step began and failed; the ledger says so."""


class RetentionRefused(RuntimeError):
    """A step was not allowed to begin; the ledger is unchanged."""


@dataclass(frozen=True)
class Retention:
    """Archive and restore jobs over one ledger and one archive folder.

    A table is a ``CatalogTable`` or a ``LiveTable``. Retention settings are
    arguments; ``as_of`` is the date the cutoff is counted from.
    """

    spark: SparkSession
    ledger: Ledger
    archive_root: str
    retention_years: int = DEFAULTS.retention_years
    window_months: int = DEFAULTS.window_months
    delete_enabled: bool = DEFAULTS.delete_enabled

    # -- windows -----------------------------------------------------------

    def next_window(
        self, table: Any, spec: TableSpec, as_of: date, explicit_start: date | None = None
    ) -> ResolvedWindow:
        start = explicit_start or self.ledger.watermark(spec.name)
        return resolve_window(
            table.oldest_part(spec), spec, as_of, start, None, self.retention_years, self.window_months
        )

    def archive_next(
        self,
        table: Any,
        spec: TableSpec,
        as_of: date,
        explicit_start: date | None = None,
        dry_run: bool = DEFAULTS.dry_run,
        transform: Transform | None = None,
    ) -> Record | None:
        """Archive the next eligible window; ``None`` where nothing is old enough."""
        found = self.next_window(table, spec, as_of, explicit_start)
        if not found.eligible:
            return None
        return self.archive_window(
            table, spec, found.window, as_of, dry_run, allow_young=True, transform=transform
        )

    def archive_pending(
        self,
        table: Any,
        spec: TableSpec,
        as_of: date,
        transform: Transform | None = None,
    ) -> list[Record]:
        """Archive every window up to the cutoff.

        Empty windows are recorded too, so gaps in the data are walked over. A
        restored window is skipped: its rows are wanted in the table. Deletes
        that had begun are finished first. Runs of windows that were never begun
        are exported, proved and deleted together (``walk``), with as many Spark
        jobs as one window takes; where that finds a fault, and for windows of
        which something is recorded, it goes window by window and ends at the
        first one that fails.
        """
        states = {Window(r.window_start, r.window_end): r for r in self.ledger.state(spec.name).collect()}
        done: list[Record] = []

        def one_by_one(windows: list[Window]) -> bool:
            for window in windows:
                done.append(self.archive_window(table, spec, window, as_of, allow_young=True, transform=transform))
                if done[-1].status is not Status.DELETED:
                    return False
            return True

        begun = (Status.RECONCILED.value, Status.DELETE_FAILED.value)
        left_over = sorted((w for w, r in states.items() if r.delete_begun and r.status in begun), key=lambda w: w.start)
        if not one_by_one(left_over):
            return done
        found = self.next_window(table, spec, as_of)
        if not found.eligible:
            return done
        pending = windows_between(self.spark, found.window_start, found.cutoff, self.window_months)
        for fresh, windows in groupby(pending, lambda w: w not in states):
            windows = [w for w in windows if w not in states or states[w].status != Status.RESTORED.value]
            if fresh and len(windows) > 1 and self.delete_enabled:
                records = archive_together(self, table, spec, windows, transform)
                if records is not None:
                    done += records
                    continue
            if not one_by_one(windows):
                break
        return done

    # -- archive -----------------------------------------------------------

    def archive_window(
        self,
        table: Any,
        spec: TableSpec,
        window: Window,
        as_of: date,
        dry_run: bool = DEFAULTS.dry_run,
        allow_young: bool = False,
        force: bool = False,
        transform: Transform | None = None,
    ) -> Record:
        """Export, reconcile, delete; stops at the first step that fails.

        A window already deleted is left alone. A rerun of any other window
        starts again at the export, under a new run directory.
        """
        if not allow_young:
            cutoff = self.next_window(table, spec, as_of, window.start).cutoff
            if window.end > cutoff:
                raise RetentionRefused(f"'{spec.name}' {window} reaches past the retention cutoff {cutoff}")
        known = self.ledger.find(spec.name, window)
        if known is not None:
            if known.predicate != spec.predicate:
                raise RetentionRefused(
                    f"'{spec.name}' {window} was archived with predicate {known.predicate!r}, "
                    f"not {spec.predicate!r}"
                )
            if known.status is Status.DELETED:
                return known
            if known.status is Status.RESTORED and not force:
                raise RetentionRefused(f"'{spec.name}' {window} was restored; archive it again with force=True")
            if known.status in (Status.RECONCILED, Status.DELETE_FAILED) and not dry_run:
                finished = self._finish_delete(table, spec, window, known, transform)
                if finished is not None:
                    return finished
        record = self.export_window(table, spec, window, transform)
        record = self.reconcile_window(table, spec, window, transform, record)
        return self.delete_window(table, spec, window, dry_run, transform, record)

    def export_window(
        self, table: Any, spec: TableSpec, window: Window, transform: Transform | None = None
    ) -> Record:
        token = uuid.uuid4().hex
        at = datetime.now(timezone.utc)
        record = self._record(spec, window, Status.STARTED, token, delete_begun=False)
        try:
            spec = with_declared(spec, table)
            found = window_scan(table.read(window), spec, window)
            rows = archive_rows(found, spec, transform)
            if transform is not None:
                refuse_lost_rows(found, rows, spec.pk)
            path = f"{self.archive_root.rstrip('/')}/{safe_name(spec.name)}/run={token}"
            stats = write_archive(rows, spec, path, file_stem(spec, token, at))
            bad = {c: n for c, n in stats.null_rows.items() if n}
            if bad:
                raise RetentionError(self._null_message(rows, spec, bad))
            files = manifest(read_archive(self.spark, path, rows.schema), path)
            n_files, n_rows = self.ledger.record_manifest(spec.name, window, token, files)
            if n_rows != stats.rows:
                raise RetentionError(f"{stats.rows} rows were handed to the writer, the files hold {n_rows}")
        except Exception as failure:
            self._fail(spec, record, Status.EXPORT_FAILED, failure)
        return self._record(
            spec,
            window,
            Status.EXPORTED,
            token,
            record,
            exported=stats.rows,
            export_run=token,
            archive_path=path,
            archive_schema=rows.schema.json(),
            n_files=n_files,
            transformed=transform is not None,
        )

    def reconcile_window(
        self,
        table: Any,
        spec: TableSpec,
        window: Window,
        transform: Transform | None = None,
        record: Record | None = None,
    ) -> Record:
        record = record or self.ledger.find(spec.name, window)
        _require(record, Status.EXPORTED, spec, window, "reconcile")
        if record.exported == 0 and record.n_files == 0:
            return self._record(spec, window, Status.RECONCILED, record.run_token, record, reconciled=0)
        try:
            # A fresh read, not the rows the export held; what the files were before it is noted.
            state = table.state_of(window)
            matched = self._prove_equal(table, spec, window, record, transform)
        except Exception as failure:
            self._fail(spec, record, Status.RECONCILE_FAILED, failure)
        return self._record(
            spec,
            window,
            Status.RECONCILED,
            record.run_token,
            record,
            reconciled=matched,
            source_state=state,
        )

    def delete_window(
        self,
        table: Any,
        spec: TableSpec,
        window: Window,
        dry_run: bool = DEFAULTS.dry_run,
        transform: Transform | None = None,
        record: Record | None = None,
    ) -> Record:
        record = record or self.ledger.find(spec.name, window)
        if record is not None and record.status is Status.DELETED:
            return record
        _require(record, Status.RECONCILED, spec, window, "delete")
        token = record.run_token
        if not self.delete_enabled or dry_run:
            there = window_count(table.read(window), spec, window).first().n_rows
            reason = "dry run" if self.delete_enabled else "deletes are switched off"
            reason = f"{reason}: {there} rows would be deleted"
            return self._record(spec, window, Status.DELETE_SKIPPED, token, record, error=reason)
        try:
            if record.reconciled == 0:
                there = window_count(table.read(window), spec, window).first().n_rows
                if there:
                    raise RetentionError(f"{there} rows appeared in the window after reconciliation")
                deleted = 0
            else:
                state = table.state_of(window)
                if state is None or state != record.source_state:
                    # The window's files may have changed since reconcile: prove
                    # the window again for those the delete will start from.
                    self._prove_equal(table, spec, window, record, transform)
                record = self._record(spec, window, Status.RECONCILED, token, record, delete_begun=True)
                archived = self._archived_rows(table, spec, record)
                deleted = table.delete_window(spec, window, record.reconciled, archived)
        except Exception as failure:
            self._fail(spec, record, Status.DELETE_FAILED, failure)
        return self._record(spec, window, Status.DELETED, token, record, deleted=deleted)

    # -- restore -----------------------------------------------------------

    def restore_files(
        self, table: Any, spec: TableSpec, files: list[str] | DataFrame, allow_missing_columns: bool = False
    ) -> Record:
        """Put the rows of one archived window back, from exactly the named files.

        The window is never an input: it is what the ledger recorded for the
        files' base names. Files may have been moved since the export. They are
        given as a list, or as a table with a column ``file_path``.

        Rows in the window are refused, unless a restore had begun and they are
        exactly the files' rows: then it was cut short after its insert, and is
        recorded as done.
        """
        if named_files(self.spark, files).isEmpty():
            raise RetentionRefused("no archive file was named")
        record, spec = self._window_of(spec, files)
        window = record.window
        if record.status is Status.RESTORED:
            return record
        if record.status not in (Status.DELETED, Status.RESTORE_FAILED, Status.RESTORE_STARTED):
            raise RetentionRefused(f"'{spec.name}' {window} is {record.status.value}, it cannot be restored")
        if record.transformed:
            raise RetentionRefused(f"'{spec.name}' {window} was exported with a transform")
        there = window_count(table.read(window), spec, window).first().n_rows
        expected = record.reconciled if record.reconciled is not None else record.exported or 0
        token = record.run_token
        if there:
            begun = record.status in (Status.RESTORE_STARTED, Status.RESTORE_FAILED)
            if not (begun and there == expected and self._already_restored(table, spec, record, files)):
                raise RetentionRefused(f"'{spec.name}' already has {there} rows in {window}")
            if record.status is Status.RESTORE_FAILED:
                record = self._record(spec, window, Status.RESTORE_STARTED, token, record)
            return self._record(spec, window, Status.RESTORED, token, record, restored=there)
        record = self._record(spec, window, Status.RESTORE_STARTED, token, record)
        try:
            archived = T.StructType.fromJson(json.loads(record.archive_schema))
            rows = archive_scan(self.spark, files, archived)
            current = table.schema()
            rows = as_source(rows, current)
            n, repeated = key_totals(rows, spec.pk)
            if n != expected:
                raise RetentionError(f"the named files hold {n} rows, the window has {expected}")
            if repeated:
                raise RetentionError("the named files hold the same key more than once")
            # Checks the columns; what gets written is the restored part only.
            restore_union(self.spark.createDataFrame([], current), rows, allow_missing_columns)
            written = table.insert(_fill_added(rows, current), spec)
            after = window_count(table.read(window), spec, window).first().n_rows
            if written != expected or after != expected:
                raise RetentionError(f"{written} rows were written and {after} are there; expected {expected}")
        except Exception as failure:
            self._fail(spec, record, Status.RESTORE_FAILED, failure)
        return self._record(spec, window, Status.RESTORED, token, record, restored=written)

    # -- inside ------------------------------------------------------------

    def _window_of(self, spec: TableSpec, files: list[str] | DataFrame) -> tuple[Record, TableSpec]:
        found = resolve_files(named_files(self.spark, files), self.ledger.manifest(spec.name)).first()
        if found.n_unknown:
            raise RetentionRefused(
                f"{found.n_unknown} file(s), for example '{found.an_unknown}', "
                f"are not recorded exports of '{spec.name}'"
            )
        if found.n_windows != 1:
            raise RetentionRefused("the named files belong to different windows")
        record = self.ledger.find(spec.name, Window(found.window_start, found.window_end))
        if found.n_runs != 1 or found.run_token != record.export_run:
            raise RetentionRefused("the named files are from a run that a later export replaced")
        # The predicate the window was archived with, whatever the caller holds.
        return record, spec.with_predicate(record.predicate)

    def _already_restored(
        self, table: Any, spec: TableSpec, record: Record, files: list[str] | DataFrame
    ) -> bool:
        """Whether the window's rows are the files' rows, as multisets; columns added since the export are NULL."""
        archived = T.StructType.fromJson(json.loads(record.archive_schema))
        current = table.schema()
        rows = _fill_added(as_source(archive_scan(self.spark, files, archived), current), current)
        live = window_scan(table.read(record.window), spec, record.window)
        if not same_columns(rows.schema, live.schema):
            return False
        return tuple(set_equality(live, rows).first()) == (0, 0)

    def _prove_equal(
        self,
        table: Any,
        spec: TableSpec,
        window: Window,
        record: Record,
        transform: Transform | None,
    ) -> int:
        """Fail unless the window's live rows are exactly the archived rows."""
        live, archived = self._both_sides(table, spec, window, record, transform)
        profile = key_profile(live, archived, spec.pk)
        problem = _count_problem(profile, record.exported)
        if problem is None:
            first = first_mismatch(diff(live, archived, spec.pk, profile), spec.pk).first()
            if first is not None:
                key = ", ".join(f"{c}={first[c]}" for c in spec.pk)
                problem = f"{first.verdict} at {key}, column(s) {first.mismatch_columns}"
        if problem:
            raise RetentionError(problem)
        return profile.archive_rows

    def _finish_delete(
        self,
        table: Any,
        spec: TableSpec,
        window: Window,
        record: Record,
        transform: Transform | None,
    ) -> Record | None:
        """Complete a delete that removed some or all rows before its process died.

        Exporting such a window again would replace the only full archive by a
        partial one. Rows that are gone although no delete had begun were removed by
        someone else: such a window is exported afresh, as is one of which nothing
        was removed. Then the result is ``None``.
        """
        if not record.reconciled or not record.delete_begun or not self.delete_enabled:
            return None
        live, archived = self._both_sides(table, spec, window, record, transform)
        profile = key_profile(live, archived, spec.pk)
        if profile.missing_in_source == 0:
            return None
        others = diff(live, archived, spec.pk, profile).where(
            ~F.col("verdict").isin(MATCH, MISSING_IN_SOURCE)
        )
        if not others.isEmpty():
            raise RetentionRefused(
                f"'{spec.name}' {window}: rows archived by run {record.export_run} are gone from the "
                f"table and others are not in its files; neither run can be finished"
            )
        try:
            if profile.source_rows:
                archived = self._archived_rows(table, spec, record)
                table.delete_window(spec, window, profile.source_rows, archived)
        except Exception as failure:
            self._fail(spec, record, Status.DELETE_FAILED, failure)
        return self._record(
            spec, window, Status.DELETED, record.run_token, record, deleted=record.reconciled
        )

    def _both_sides(
        self,
        table: Any,
        spec: TableSpec,
        window: Window,
        record: Record,
        transform: Transform | None,
    ) -> tuple[DataFrame, DataFrame]:
        """The window's live rows as the archive would store them, and the archived rows."""
        live = archive_rows(window_scan(table.read(window), spec, window), spec, transform)
        schema = T.StructType.fromJson(json.loads(record.archive_schema))
        if not same_columns(live.schema, schema):
            raise RetentionError("the table's columns changed since the export")
        return live, read_archive(self.spark, record.archive_path, schema).drop(KEY)

    def _archived_rows(self, table: Any, spec: TableSpec, record: Record) -> DataFrame:
        """The archived rows in the table's types; their keys alone where a transform changed the rest."""
        schema = T.StructType.fromJson(json.loads(record.archive_schema))
        rows = as_source(read_archive(self.spark, record.archive_path, schema).drop(KEY), table.schema())
        return rows.select(*[quoted(c) for c in spec.pk]) if record.transformed else rows

    def _record(
        self,
        spec: TableSpec,
        window: Window,
        status: Status,
        token: str,
        after: Record | None = None,
        **values,
    ) -> Record:
        return self.ledger.record(
            spec.name, window, status, token, predicate=spec.predicate, after=after, **values
        )

    def _fail(self, spec: TableSpec, record: Record, status: Status, failure: Exception) -> None:
        """Record the failure first, then raise it."""
        self._record(spec, record.window, status, record.run_token, record, error=str(failure))
        raise RetentionError(f"'{spec.name}' {record.window}: {failure}") from failure

    def _null_message(self, rows: DataFrame, spec: TableSpec, bad: dict[str, int]) -> str:
        any_null = " or ".join(f"{quoted(c)} is null" for c in bad)
        sample = rows.where(any_null).first()
        return f"NULL in required column(s) {bad}, for example {sample.asDict()}"


def _require(record: Record | None, status: Status, spec: TableSpec, window: Window, step: str) -> None:
    if record is None or record.status is not status:
        found = record.status.value if record else "not started"
        raise RetentionRefused(f"cannot {step} '{spec.name}' {window}: it is {found}")


def _count_problem(profile: KeyProfile, exported: int) -> str | None:
    if profile.duplicate_keys:
        return f"{profile.duplicate_keys} key(s) occur more than once"
    if profile.archive_rows != exported:
        return f"the files hold {profile.archive_rows} rows, {exported} were exported"
    if profile.source_rows != exported:
        return f"the table has {profile.source_rows} rows in the window, {exported} were exported"
    return None


def _fill_added(rows: DataFrame, table: T.StructType) -> DataFrame:
    return rows.select(
        *[
            F.col(quoted(f.name)) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in table.fields
        ]
    )
