"""A Parquet table of Spark's catalog, partitioned by calendar period, from which a window can be removed and put back.

The catalog says which folder holds a period. Periods that lie wholly inside a
window are dropped unread; of those that the window cuts through, the rows that
stay are written to a new folder, which the catalog is then pointed to. Putting
rows back adds periods in the same way. A statement to the catalog takes effect
as a whole and comes only after all files are written and counted; neither step
costs more than the window it concerns. Where a table format with DELETE is
available, that is the better choice.

Files of periods that were dropped or replaced go with the table's kind: Spark
deletes those of a managed table when it drops the period and keeps those of an
external one, which its owner removes.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from coldshelf.functions.columns import archive_key, col, require_date
from coldshelf.operators.delete import survivors_of_window
from coldshelf.operators.export import clustered
from coldshelf.spec import Granularity, TableSpec, Window, quoted, same_columns

PERIOD = "period"
#: Where rows without a date lie.
UNKNOWN = "unknown"
#: Table property with the names of the columns declared NOT NULL, which Parquet tables do not keep.
NOT_NULL = "coldshelf.not_null"


class CatalogTable:
    """``name`` is the table's name in the catalog; ``period`` is what its column ``period`` was made from."""

    def __init__(self, spark: SparkSession, name: str, period: Granularity = Granularity.MONTH):
        if period is Granularity.NONE:
            raise ValueError("a table needs a period")
        self.spark = spark
        self.name = name
        self.period = period

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        name: str,
        rows: DataFrame,
        spec: TableSpec,
        period: Granularity = Granularity.MONTH,
        location: str | None = None,
    ) -> CatalogTable:
        """Write the rows as a new table: an external one at ``location``, else a managed one."""
        if PERIOD in (c.lower() for c in rows.columns):
            raise ValueError(f"the column '{PERIOD}' is the table's own")
        table = cls(spark, name, period)
        writer = table._sorted(table._filed(rows, spec), spec).write.format("parquet").partitionBy(PERIOD)
        if location:
            writer = writer.option("path", location)
        writer.mode("errorifexists").saveAsTable(name)
        declared = json.dumps([f.name for f in rows.schema.fields if not f.nullable])
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_text(NOT_NULL)} = {_text(declared)})")
        return table

    # -- reading -----------------------------------------------------------

    def read(self, window: Window | None = None) -> DataFrame:
        """The table's rows; with a window, only of the periods the window touches."""
        return self._touched(window).drop(PERIOD)

    def schema(self) -> T.StructType:
        found = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        declared = json.loads(found.get(NOT_NULL, "[]"))
        fields = self.spark.table(self.name).drop(PERIOD).schema.fields
        return T.StructType([T.StructField(f.name, f.dataType, f.name not in declared, f.metadata) for f in fields])

    def oldest_part(self, spec: TableSpec) -> DataFrame:
        """Rows among which the oldest date is found, without listing the whole table.

        That is the earliest period; with an extra predicate any period may hold it.
        """
        periods = [p for p in self.periods() if p != UNKNOWN]
        if spec.predicate or not periods:
            return self.read()
        return self.spark.table(self.name).where(F.col(PERIOD) == min(periods)).drop(PERIOD)

    def periods(self) -> list[str]:
        """The table's periods: as many as the calendar has, however many rows there are."""
        return [r.partition.split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]

    def state_of(self, window: Window) -> int:
        """A number that changes with the files in which the window's rows lie; reads no column."""
        names = ("file_path", "file_size", "file_modification_time")
        files = self._touched(window).select(*[f"_metadata.{n}" for n in names]).distinct()
        return files.agg(F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64(*names)))).first()[0]

    # -- writing -----------------------------------------------------------

    def delete_window(
        self, spec: TableSpec, window: Window, expected: int, archived: DataFrame | None = None
    ) -> int:
        """Remove the window's rows; unless exactly ``expected`` rows would go, none does.

        The archived rows are not needed: the files they were proved against are
        those that ``state_of`` told.
        """
        slack = self._slack()
        touched = [p for p in self.periods() if self._touches(p, window, slack)]
        whole = [] if spec.predicate else [p for p in touched if self._inside(p, window, slack)]
        cut = [p for p in touched if p not in whole]
        before = _sizes(self._of(touched))
        folder, left = self._folder(), {}
        if cut:
            left = self._write(survivors_of_window(self._of(cut), spec, window), spec, folder)
        deleted = sum(before.values()) - sum(left.values())
        if deleted != expected:
            raise ValueError(f"would delete {deleted} rows where {expected} were reconciled")
        self._point([p for p in left if left[p] != before[p]], folder)
        gone = [p for p in touched if p not in left]
        if gone:
            self._alter("DROP IF EXISTS " + ", ".join(map(_partition, gone)))
        return deleted

    def insert(self, rows: DataFrame, spec: TableSpec) -> int:
        """Add the rows to the table; returns how many. Periods it has already are written anew with both."""
        if not same_columns(rows.schema, self.schema()):
            raise ValueError("the rows do not have the table's columns")
        folder = self._folder()
        added = self._write(self._filed(rows, spec), spec, folder)
        known = sorted(set(added) & set(self.periods()))
        if known:
            self._write(self._of(known), spec, folder)
        self._point(known, folder)
        fresh = [f"{_partition(p)} LOCATION {_text(_place(folder, p))}" for p in added if p not in known]
        if fresh:
            self._alter("ADD " + " ".join(fresh))
        return sum(added.values())

    def add_columns(self, fields: list[T.StructField]) -> None:
        """Add nullable columns; existing rows read them as NULL."""
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        self._alter(f"ADD COLUMNS ({columns})")

    # -- inside ------------------------------------------------------------

    def _touched(self, window: Window | None) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows if window is None else rows.where(self._between(rows.schema, window))

    def _of(self, periods: list[str]) -> DataFrame:
        return self.spark.table(self.name).where(F.col(PERIOD).isin(periods))

    def _filed(self, rows: DataFrame, spec: TableSpec) -> DataFrame:
        require_date(rows.schema, spec.date_col)
        return rows.withColumn(PERIOD, archive_key(col(spec.date_col), self.period))

    def _sorted(self, filed: DataFrame, spec: TableSpec) -> DataFrame:
        """Rows by period and date, so that scans can skip row groups; a large period is cut over several tasks."""
        return clustered(filed, PERIOD, spec.pk).sortWithinPartitions(PERIOD, col(spec.date_col))

    def _write(self, filed: DataFrame, spec: TableSpec, folder: str) -> dict[str, int]:
        """Add rows to a folder that the catalog does not know yet; rows for each period written."""
        seen = self.spark.read.schema(filed.schema)
        self._sorted(filed, spec).write.mode("append").partitionBy(PERIOD).parquet(folder)
        return _sizes(seen.parquet(folder))

    def _folder(self) -> str:
        """A new folder below the table's own."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()
        root = [r.data_type for r in described if r.col_name == "Location"][-1]
        return f"{root.rstrip('/')}/_w{uuid.uuid4().hex}"

    def _point(self, periods: list[str], folder: str) -> None:
        for period in periods:
            self._alter(f"{_partition(period)} SET LOCATION {_text(_place(folder, period))}")

    def _alter(self, change: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} {change}")

    def _slack(self) -> timedelta:
        return _slack(self.spark.table(self.name).schema)

    def _label(self, day: date) -> str:
        return {
            Granularity.EXACT_DATE: f"{day:%Y-%m-%d}",
            Granularity.MONTH: f"{day:%Y-%m}",
            Granularity.YEAR: f"{day:%Y}",
        }[self.period]

    def _ends(self, window: Window, slack: timedelta) -> tuple[str, str]:
        return self._label(window.start - slack), self._label(window.end - timedelta(days=1) + slack)

    def _between(self, schema: T.StructType, window: Window) -> Column:
        return F.col(PERIOD).between(*self._ends(window, _slack(schema))) & (F.col(PERIOD) != UNKNOWN)

    def _touches(self, period: str, window: Window, slack: timedelta) -> bool:
        first, last = self._ends(window, slack)
        return period != UNKNOWN and first <= period <= last

    def _inside(self, period: str, window: Window, slack: timedelta) -> bool:
        """Whether every date of the period lies in the window."""
        before = self._label(window.start - timedelta(days=1) + slack)
        return period != UNKNOWN and before < period < self._label(window.end - slack)


def _slack(schema: T.StructType) -> timedelta:
    """How far a row's date may be from its period: instants were filed under the date of another session's zone."""
    zoned = any(isinstance(f.dataType, T.TimestampType) for f in schema.fields)
    return timedelta(days=1 if zoned else 0)


def _sizes(filed: DataFrame) -> dict[str, int]:
    return {r[PERIOD]: r["count"] for r in filed.groupBy(PERIOD).count().collect()}


def _place(folder: str, period: str) -> str:
    return f"{folder}/{PERIOD}={period}"


def _partition(period: str) -> str:
    return f"PARTITION ({PERIOD} = {_text(period)})"


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
