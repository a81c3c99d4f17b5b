"""The ledger: an append-only table of run events and the state folded from it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone
from enum import Enum
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from coldshelf.operators.export import safe_name
from coldshelf.operators.restore import WINDOW_KEY
from coldshelf.session import numbered_folders
from coldshelf.spec import Window


class Status(str, Enum):
    """Status of one table and window; fixed values."""

    STARTED = "STARTED"
    EXPORTED = "EXPORTED"
    EXPORT_FAILED = "EXPORT_FAILED"
    RECONCILED = "RECONCILED"
    RECONCILE_FAILED = "RECONCILE_FAILED"
    DELETED = "DELETED"
    DELETE_SKIPPED = "DELETE_SKIPPED"
    DELETE_FAILED = "DELETE_FAILED"
    RESTORE_STARTED = "RESTORE_STARTED"
    RESTORED = "RESTORED"
    RESTORE_SKIPPED = "RESTORE_SKIPPED"
    RESTORE_FAILED = "RESTORE_FAILED"


# Which status may follow which. A new archive run may begin from any of them.
FOLLOWS = {
    Status.STARTED: {Status.EXPORTED, Status.EXPORT_FAILED},
    Status.EXPORTED: {Status.RECONCILED, Status.RECONCILE_FAILED},
    # A second RECONCILED notes that the delete begins.
    Status.RECONCILED: {Status.RECONCILED, Status.DELETED, Status.DELETE_SKIPPED, Status.DELETE_FAILED},
    Status.DELETED: {Status.RESTORE_STARTED},
    Status.RESTORE_FAILED: {Status.RESTORE_STARTED},
    # A delete that was cut short is finished by the next run.
    Status.DELETE_FAILED: {Status.DELETED, Status.DELETE_FAILED},
    # A restore whose process died may be tried again: the window must be empty, or hold exactly its rows.
    Status.RESTORE_STARTED: {Status.RESTORE_STARTED, Status.RESTORED, Status.RESTORE_FAILED},
}

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("window_start", T.DateType()),
        T.StructField("window_end", T.DateType()),
        T.StructField("predicate", T.StringType()),
        T.StructField("run_token", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("exported", T.LongType()),
        T.StructField("reconciled", T.LongType()),
        T.StructField("deleted", T.LongType()),
        T.StructField("restored", T.LongType()),
        T.StructField("export_run", T.StringType()),
        T.StructField("archive_path", T.StringType()),
        T.StructField("archive_schema", T.StringType()),
        T.StructField("n_files", T.LongType()),
        T.StructField("transformed", T.BooleanType()),
        T.StructField("source_state", T.LongType()),
        T.StructField("delete_begun", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# Columns that keep their last known value when an event does not set them.
CARRIED = [
    "exported",
    "reconciled",
    "deleted",
    "restored",
    "export_run",
    "archive_path",
    "archive_schema",
    "n_files",
    "transformed",
    "source_state",
    "delete_begun",
]
# Columns that every event replaces.
REPLACED = ["at", "predicate", "run_token", "status", "error_message"]

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("window_start", T.DateType()),
        T.StructField("window_end", T.DateType()),
        T.StructField("run_token", T.StringType()),
        T.StructField("archive_key", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("base_name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


class LedgerConflict(RuntimeError):
    """Another writer recorded an event for the same table at the same time."""


def fold(events: DataFrame, carried: list[str], replaced: list[str]) -> DataFrame:
    """Latest state per table and window, from events ordered by ``seq``.

    One aggregation with partial results before the shuffle; a table with very
    many events does not gather them in one task.
    """
    return (
        events.groupBy(*WINDOW_KEY)
        .agg(
            F.max("seq").alias("seq"),
            F.max_by(F.struct(*replaced), "seq").alias("latest"),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in carried],
        )
        .select(*WINDOW_KEY, "seq", "latest.*", *carried)
    )


def watermark(state: DataFrame) -> DataFrame:
    """Per table, the latest end of a window that reached DELETED."""
    return (
        state.where(F.col("status") == Status.DELETED.value)
        .groupBy("table_name")
        .agg(F.max("window_end").alias("watermark"))
    )


@dataclass(frozen=True)
class Record:
    """State of one table and window."""

    seq: int
    table_name: str
    window: Window
    status: Status
    predicate: str | None
    run_token: str | None
    exported: int | None
    reconciled: int | None
    deleted: int | None
    restored: int | None
    export_run: str | None
    archive_path: str | None
    archive_schema: str | None
    n_files: int | None
    transformed: bool | None
    source_state: int | None
    delete_begun: bool | None
    error_message: str | None
    at: datetime | None


def _follow(known: Record | None, table: str, window: Window, seq: int, values: dict) -> Record:
    """The state after an event: counts and files are carried on, the rest is replaced."""
    before, status = known.status if known else None, values["status"]
    if status is not Status.STARTED and status not in FOLLOWS.get(before, set()):
        raise LedgerConflict(f"'{table}' {window}: {status.value} may not follow {before and before.value}")
    carried = {c: values[c] if values.get(c) is not None else getattr(known, c, None) for c in CARRIED}
    return Record(seq=seq, table_name=table, window=window, **{**values, **carried})


class Ledger:
    """Events and manifests below one folder on shared storage.

    An event holds what it changes and the counts and files known before it.
    Events recorded together, one or one for each of several windows, are a
    directory, ``table_name=<t>/seq=<n>``, created only if absent: two writers that
    pick the same number cannot both succeed.
    After every ``COMPACT`` of them the state they lead to is written as one
    table, so a lookup reads that and the events since, however long the history.
    The part files of a run are listed by a Spark job into the manifest; no
    file list passes through the driver. One writer per table at a time.
    """

    #: Event folders that are read one by one at most, but where a writer died before it wrote the state.
    COMPACT = 16

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._begun: set[tuple[str, str]] = set()

    def events(self, table: str | None = None) -> DataFrame:
        fields = [T.StructField("seq", T.LongType())] + list(EVENT_SCHEMA.fields)
        return self._read("events", T.StructType(fields), table)

    def state(self, table: str | None = None) -> DataFrame:
        return fold(self._recent(table) if table else self.events(), CARRIED, REPLACED)

    def find(self, table: str, window: Window) -> Record | None:
        return self._lookup(table, window)[1]

    def watermark(self, table: str) -> date | None:
        row = watermark(self.state(table)).first()
        return row.watermark if row else None

    def manifest(self, table: str | None = None) -> DataFrame:
        """Part files of every recorded run, superseded runs included."""
        return self._read("manifest", MANIFEST_SCHEMA, table)

    def output_files(self, table: str, window: Window) -> DataFrame:
        """Part files of the run whose export is the window's current one."""
        files = self.manifest(table).where(
            (F.col("window_start") == F.lit(window.start)) & (F.col("window_end") == F.lit(window.end))
        )
        return files.join(self._current_runs(table), [*WINDOW_KEY, "run_token"], "left_semi")

    def superseded_files(self, table: str) -> DataFrame:
        """Part files of earlier runs that a later export of the window replaced."""
        return self.manifest(table).join(
            self._current_runs(table), [*WINDOW_KEY, "run_token"], "left_anti"
        )

    def record(
        self,
        table: str,
        window: Window,
        status: Status,
        run_token: str,
        predicate: str | None = None,
        error: str | None = None,
        after: Record | None = None,
        **values,
    ) -> Record:
        """Append one event and return the state it leads to.

        ``after`` is the state the caller holds and spares reading it again; a
        caller whose state is out of date finds its event number taken.
        """
        values.update(
            at=datetime.now(timezone.utc),
            predicate=predicate,
            run_token=run_token,
            status=status,
            error_message=error or None,
        )
        latest, known = (after.seq, after) if after else self._lookup(table, window)
        record = _follow(known, table, window, latest + 1, values)
        if self._create(record):
            return record
        latest, known = self._lookup(table, window)
        if after is None and latest >= record.seq:
            raise LedgerConflict(f"another writer is recording runs of '{table}'")
        # Either the caller's state was out of date, or a writer died before it
        # committed and left a folder without an event in it.
        record = _follow(known, table, window, self._last_folder(table) + 1, values)
        if self._create(record):
            return record
        raise LedgerConflict(f"another writer is recording runs of '{table}'")

    def record_many(
        self, table: str, steps: dict[Window, Record | None], status: Status, run_token: str,
        predicate: str | None, values: dict[Window, dict] | None = None, error: str | None = None,
    ) -> dict[Window, Record]:
        """Append one event for each of several windows, all at once; ``steps`` holds the states they follow."""
        latest = self._latest(table)
        made = {}
        for number in (lambda: latest + 1, lambda: self._last_folder(table) + 1):
            seq = number()
            for window, known in steps.items():
                event = dict(
                    at=datetime.now(timezone.utc), predicate=predicate, run_token=run_token, status=status,
                    error_message=error or None, **(values or {}).get(window, {}),
                )
                made[window] = _follow(known, table, window, seq, event)
            if self._create(*made.values()):
                return made
            if self._latest(table) > latest:
                break  # else a writer died before it committed and left a folder without an event in it
        raise LedgerConflict(f"another writer is recording runs of '{table}'")

    def record_manifest(
        self, table: str, window: Window, run_token: str, files: DataFrame
    ) -> tuple[int, int]:
        """List a run's part files; returns how many there are and the rows they hold."""
        listed = Observation()
        bounds = {"window_start": F.lit(window.start), "window_end": F.lit(window.end)}
        self._listed(table, run_token, files.withColumns(bounds)).observe(
            listed, F.count("*").alias("files"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows")
        ).write.mode("errorifexists").parquet(self._manifest_folder(table, run_token))
        return listed.get["files"], listed.get["rows"]

    def record_manifests(
        self, table: str, windows: list[Window], run_token: str, files: DataFrame
    ) -> dict[Window, tuple[int, int]]:
        """List the part files of a run over several windows; for each window how many there are and their rows."""
        ends = F.create_map(*[x for w in windows for x in (F.lit(w.start), F.lit(w.end))])
        files = files.withColumn("window_end", F.element_at(ends, F.col("window_start")))
        folder = self._manifest_folder(table, run_token)
        self._listed(table, run_token, files).write.mode("errorifexists").parquet(folder)
        counts = self.spark.read.schema(MANIFEST_SCHEMA).parquet(folder).groupBy("window_start")
        found = {r.window_start: (r.n, r.rows) for r in counts.agg(F.count("*").alias("n"), F.sum("n_rows").alias("rows")).collect()}
        return {w: found.get(w.start, (0, 0)) for w in windows}

    def _listed(self, table: str, run_token: str, files: DataFrame) -> DataFrame:
        named = files.withColumns({"table_name": F.lit(table), "run_token": F.lit(run_token)})
        return named.select(*MANIFEST_SCHEMA.names)

    def _manifest_folder(self, table: str, run_token: str) -> str:
        return f"{self._folder('manifest', table)}/run={safe_name(run_token)}"

    def _current_runs(self, table: str) -> DataFrame:
        return self.state(table).select(*WINDOW_KEY, F.col("export_run").alias("run_token"))

    def _create(self, *records: Record) -> bool:
        """Write one event folder, with an event for each record; ``False`` where the number is taken."""
        events = [
            {
                **record.__dict__,
                "window_start": record.window.start,
                "window_end": record.window.end,
                "status": record.status.value,
            }
            for record in records
        ]
        if len(events) == 1:
            # Literals over a one-row range: no Python worker for a single row.
            rows = self.spark.range(0, 1, 1, 1).select(
                *[F.lit(events[0][f.name]).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
            )
        else:
            data = [tuple(event[c] for c in EVENT_SCHEMA.names) for event in events]
            rows = self.spark.createDataFrame(data, EVENT_SCHEMA).coalesce(1)
        folder = f"{self._folder('events', records[0].table_name)}/seq={records[0].seq}"
        try:
            rows.write.mode("errorifexists").parquet(folder)
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            return False
        if records[0].seq % self.COMPACT == 0:
            self._compact(records[0].table_name, records[0].seq)
        return True

    def _compact(self, table: str, upto: int) -> None:
        """Write the state after event ``upto``; the one before it stays for readers that have begun."""
        folder = self._folder("state", table)
        self.state(table).write.mode("ignore").parquet(f"{folder}/upto={upto}")
        for older in sorted(numbered_folders(self.spark, folder, "upto="))[:-2]:
            path, files = self._file(f"{folder}/upto={older}")
            files.delete(path, True)

    def _compacted(self, table: str) -> int:
        """The last event that a completely written state holds; 0 without one."""
        path, files = self._file(self._folder("state", table))
        if not files.exists(path):
            return 0
        for upto in sorted(numbered_folders(self.spark, self._folder("state", table), "upto="), reverse=True):
            path, files = self._file(f"{self._folder('state', table)}/upto={upto}/_SUCCESS")
            if files.exists(path):
                return upto
        return 0

    def _recent(self, table: str) -> DataFrame:
        """One table's events that still count: those since the last written state, which stands for the others."""
        schema = T.StructType([T.StructField("seq", T.LongType()), *EVENT_SCHEMA.fields])
        self._begin("events", schema, table)
        upto, folder = self._compacted(table), self._folder("events", table)
        recent = [n for n in numbered_folders(self.spark, folder, "seq=") if n > upto or not upto]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/events")
        parts = [reader.parquet(*[f"{folder}/seq={n}" for n in recent])] if recent else []
        if upto:
            parts.append(self.spark.read.schema(schema).parquet(f"{self._folder('state', table)}/upto={upto}"))
        found = reduce(DataFrame.union, [p.select(*schema.names) for p in parts])
        return found.where(F.col("table_name") == table)

    def _latest(self, table: str) -> int:
        return self._recent(table).agg(F.max("seq")).first()[0] or 0

    def _file(self, path: str) -> tuple[Any, Any]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _lookup(self, table: str, window: Window) -> tuple[int, Record | None]:
        """Last event number of the table, and the state of one window, in one read."""
        here = (F.col("window_start") == F.lit(window.start)) & (F.col("window_end") == F.lit(window.end))
        state = F.struct("seq", *REPLACED, *CARRIED)
        latest, found = (
            self._recent(table)
            .agg(F.max("seq"), F.max_by(state, F.when(here, F.col("seq"))))
            .first()
        )
        if found is None:
            return latest or 0, None
        values = {**found.asDict(), "status": Status(found.status)}
        return latest, Record(table_name=table, window=window, **values)

    def _last_folder(self, table: str) -> int:
        """The highest event number that has a folder, with an event in it or without."""
        return max(numbered_folders(self.spark, self._folder("events", table), "seq="), default=0)

    def _folder(self, kind: str, table: str) -> str:
        return f"{self.root}/{kind}/t={safe_name(table)}"

    def _read(self, kind: str, schema: T.StructType, table: str | None) -> DataFrame:
        """Read one table's part of the ledger, or all of it."""
        self._begin(kind, schema, table or "_")
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}")
        found = reader.parquet(self._folder(kind, table) if table else f"{self.root}/{kind}")
        found = found.select(*schema.names)
        return found.where(F.col("table_name") == table) if table else found

    def _begin(self, kind: str, schema: T.StructType, table: str) -> None:
        """Put an empty file where nothing was recorded yet, so that reads need no special case."""
        if (kind, table) in self._begun:
            return
        first = "seq=0" if kind == "events" else "run=none"
        stored = [f for f in schema.fields if f.name != "seq"]
        empty = self.spark.createDataFrame([], T.StructType(stored))
        empty.write.mode("ignore").parquet(f"{self._folder(kind, table)}/{first}")
        self._begun.add((kind, table))
