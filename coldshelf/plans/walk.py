"""Archiving a run of consecutive windows together.

One export with the window as a folder above the archive key, one proof over all
of it, one delete; each step is one append to the ledger, with an event for every
window. How many Spark jobs that takes does not depend on how many windows
there are. What is recorded, and where a window's files lie, is as if each window
had been archived by itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame, functions as F

from coldshelf.functions.columns import col
from coldshelf.operators.export import (
    KEY,
    WINDOW,
    archive_rows,
    file_stem,
    read_windows,
    refuse_lost_rows,
    safe_name,
    window_number,
    window_path,
    windows_manifest,
    write_windows,
)
from coldshelf.operators.reconcile import first_mismatch, diff, key_profile
from coldshelf.plans.ledger import Record, Status
from coldshelf.plans.tabletypes import as_source, with_declared
from coldshelf.sources.scan import window_scan
from coldshelf.spec import TableSpec, Window, quoted

if TYPE_CHECKING:
    from coldshelf.plans.jobs import Retention


def rows_by_window(rows: DataFrame, spec: TableSpec, windows: list[Window]) -> list[int]:
    """How many of the rows lie in each of consecutive windows; one aggregate."""
    counts = rows.groupBy(window_number(col(spec.date_col), windows).alias("nth")).count().collect()
    found = {r.nth: r["count"] for r in counts}
    return [found.get(i + 1, 0) for i in range(len(windows))]


def archive_together(
    jobs: Retention,
    table: Any,
    spec: TableSpec,
    windows: list[Window],
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> list[Record] | None:
    """Export, reconcile and delete consecutive windows; ``None``, with no row deleted, where a step finds a fault."""
    ledger, token, at = jobs.ledger, uuid.uuid4().hex, datetime.now(timezone.utc)
    span = Window(windows[0].start, windows[-1].end)

    def recorded(status: Status, values: dict[Window, dict] | None = None, error: str | None = None) -> dict[Window, Record]:
        return ledger.record_many(spec.name, states, status, token, spec.predicate, values, error)

    def live() -> DataFrame:
        return window_scan(table.read(span), spec, span)

    states: dict[Window, Record | None] = dict.fromkeys(windows)
    states = recorded(Status.STARTED)

    # Export: what one window must not hold, none of them may.
    checked = with_declared(spec, table)
    rows = archive_rows(live(), checked, transform)
    if transform is not None:
        try:
            refuse_lost_rows(live(), rows, spec.pk)
        except ValueError:
            return None
    path = f"{jobs.archive_root.rstrip('/')}/{safe_name(spec.name)}/run={token}"
    sizes = rows_by_window(live(), spec, windows)
    stats = write_windows(rows, checked, path, file_stem(spec, token, at), windows, sizes)
    archive = read_windows(jobs.spark, path, rows.schema)
    files = ledger.record_manifests(spec.name, windows, token, windows_manifest(archive, path))
    if any(stats.null_rows.values()) or sum(n for _, n in files.values()) != stats.rows:
        return None
    states = recorded(
        Status.EXPORTED,
        {
            w: dict(
                exported=n_rows,
                export_run=token,
                archive_path=window_path(path, w),
                archive_schema=rows.schema.json(),
                n_files=n_files,
                transformed=transform is not None,
            )
            for w, (n_files, n_rows) in files.items()
        },
    )

    # Proof: all rows against all files, and each file's rows against its window.
    archived = archive.drop(WINDOW, KEY)

    def proved() -> bool:
        now = archive_rows(live(), spec, transform)
        profile = key_profile(now, archived, spec.pk)
        if profile.duplicate_keys or profile.archive_rows != stats.rows or profile.source_rows != stats.rows:
            return False
        return first_mismatch(diff(now, archived, spec.pk, profile), spec.pk).first() is None

    starts = F.array(*[F.lit(w.start.isoformat()) for w in windows])
    own = F.element_at(starts, window_number(col(spec.date_col), windows))
    state = table.state_of(span)
    if not proved() or not archive.where(own != F.col(WINDOW)).isEmpty():
        return None
    states = recorded(Status.RECONCILED, {w: dict(reconciled=files[w][1]) for w in windows})

    # Delete: from the files that were proved, or after a second proof.
    try:
        if (state is None or state != table.state_of(span)) and not proved():
            return None
        states = recorded(Status.RECONCILED, {w: dict(delete_begun=True) for w in windows if files[w][1]})
        if stats.rows:
            gone = as_source(archived, table.schema())
            gone = gone.select(*[quoted(c) for c in spec.pk]) if transform is not None else gone
            table.delete_window(spec, span, stats.rows, gone)
    except Exception as failure:
        recorded(Status.DELETE_FAILED, error=str(failure))
        from coldshelf.plans.jobs import RetentionError

        raise RetentionError(f"'{spec.name}' {span}: {failure}") from failure
    return list(recorded(Status.DELETED, {w: dict(deleted=files[w][1]) for w in windows}).values())
