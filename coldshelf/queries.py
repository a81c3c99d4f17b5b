"""The registered queries: every operator and job, run on the given tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as Window_, functions as F, types as T

from coldshelf.functions.columns import safe_key as safe_key_of
from coldshelf.operators import delete as delete_ops
from coldshelf.operators import export as export_ops
from coldshelf.operators import reconcile as reconcile_ops
from coldshelf.operators import restore as restore_ops
from coldshelf.plans import ledger as ledger_ops
from coldshelf.plans import windows as window_ops
from coldshelf.plans.jobs import Retention, RetentionError
from coldshelf.plans.ledger import Record
from coldshelf.sources import scan
from coldshelf.sources.archive import archive_scan
from coldshelf.sources.catalog import CatalogTable
from coldshelf.sources.live import LiveTable
from coldshelf.sources.rowfiles import RowFiles
from coldshelf.session import scratch_dir
from coldshelf.spec import Granularity, TableSpec, Window

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2003, 1, 1)
EVENTS_AS_OF = date(2030, 1, 1)

FIRST_WINDOW = Window(date(1995, 1, 1), date(1995, 5, 1))
MOST_YEARS = Window(date(1995, 1, 1), date(2001, 1, 1))
ALL_YEARS = Window(date(1995, 1, 1), date(2002, 1, 1))
EVENT_WINDOW = Window(date(2024, 1, 1), date(2024, 5, 1))

ORDERS = TableSpec(
    "orders", pk="o_orderkey", date_col="o_orderdate", required=("o_orderkey", "o_orderdate")
)
EVENTS = TableSpec("events", pk="event_id", date_col="ts", granularity=Granularity.EXACT_DATE)
PREDICATE = "o_orderstatus = 'F' OR o_orderpriority LIKE '1%'"
LINE_KEY = ("l_orderkey", "l_linenumber")
BATCH_ROWS = 500
FILE_ROWS = 100

STATUSES = [s.value for s in ledger_ops.Status]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- inputs derived from the tables ---------------------------------------


def orders_with_nulls(orders: DataFrame) -> DataFrame:
    """Orders as a source whose required columns are not always filled."""
    return orders.withColumn(
        "o_orderkey", F.when(~_order(status="P", priority="5-LOW"), F.col("o_orderkey"))
    ).withColumn("o_orderdate", F.when(F.col("o_totalprice") >= 1000, F.col("o_orderdate")))


def _order(status: str, priority: str) -> Column:
    return (F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == priority)


def damaged_orders(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of most years, and an archive of them with every kind of fault.

    The archive has one month too many, lacks some orders, holds a wrong price
    in some and has lost the customer of others.
    """
    source = scan.window_scan(orders, ORDERS, MOST_YEARS)
    wider = scan.window_scan(orders, ORDERS, Window(MOST_YEARS.start, date(2001, 2, 1)))
    archive = (
        wider.where(~_order("P", "1-URGENT"))
        .withColumn(
            "o_totalprice",
            F.when(_order("P", "2-HIGH"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        )
        .withColumn("o_custkey", F.when(~_order("P", "5-LOW"), F.col("o_custkey")))
    )
    return source, archive


def damaged_documents(documents: DataFrame) -> DataFrame:
    """An archive of the documents: French texts lost a trailing character, one source is missing."""
    return documents.where(F.col("source") != "src7").withColumn(
        "text", F.when(F.col("lang") == "fr", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    )


def derived_events(events: DataFrame) -> DataFrame:
    """Ledger events made from the events table: one table per type, one window per day."""
    known = F.col("value") < 30
    status = F.element_at(
        F.array(*[F.lit(s) for s in STATUSES]), (F.col("user_id") % len(STATUSES) + 1).cast("int")
    )
    day = F.to_date("ts")
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("table_name"),
        day.alias("window_start"),
        F.date_add(day, 1).alias("window_end"),
        status.alias("status"),
        F.when(status.endswith("FAILED"), F.col("props")).alias("error_message"),
        F.when(known, F.col("user_id")).alias("exported"),
        F.when(~known, F.col("user_id") + 1).alias("reconciled"),
        F.when(F.col("value") < 10, F.col("user_id") + 2).alias("deleted"),
        F.when(F.col("value") > 90, F.col("user_id") + 3).alias("restored"),
        F.when(known, F.concat(F.lit("run-"), F.col("event_id"))).alias("export_run"),
    )


FOLDED = ["exported", "reconciled", "deleted", "restored", "export_run"]


def derived_state(events: DataFrame) -> DataFrame:
    return ledger_ops.fold(derived_events(events), FOLDED, ["status", "error_message"])


def derived_manifest(events: DataFrame) -> DataFrame:
    """One recorded part file per event."""
    day = F.to_date("ts")
    return events.select(
        F.col("event_type").alias("table_name"),
        day.alias("window_start"),
        F.date_add(day, 1).alias("window_end"),
        F.concat(F.lit("run-"), day.cast("string")).alias("run_token"),
        F.concat(F.lit("part-"), F.col("event_id"), F.lit(".parquet")).alias("base_name"),
    )


def given_files(events: DataFrame) -> DataFrame:
    """Files someone holds: all recorded ones, moved elsewhere, some under a strange name."""
    name = F.when(F.col("value") < 20, F.lit("stray-")).otherwise(F.lit("part-"))
    return events.select(
        F.concat(F.lit("/cold/"), F.col("event_type"), F.lit("/"), name, F.col("event_id"), F.lit(".parquet"))
        .alias("file_path")
    )


# -- queries ---------------------------------------------------------------


def window_scan(spark, sf_dir):
    return scan.window_scan(table(spark, sf_dir, "orders"), ORDERS, FIRST_WINDOW)


def window_scan_predicate(spark, sf_dir):
    spec = ORDERS.with_predicate(PREDICATE)
    return scan.window_scan(table(spark, sf_dir, "orders"), spec, MOST_YEARS)


def window_count(spark, sf_dir):
    return scan.window_count(table(spark, sf_dir, "orders"), ORDERS, FIRST_WINDOW)


def oldest_date(spark, sf_dir):
    orders = scan.oldest_date(table(spark, sf_dir, "orders"), ORDERS)
    events = scan.oldest_date(table(spark, sf_dir, "events"), EVENTS)
    return orders.withColumn("table_name", F.lit("orders")).unionByName(
        events.withColumn("table_name", F.lit("events"))
    )


def schema_discovery(spark, sf_dir):
    return scan.schema_discovery(orders_with_nulls(table(spark, sf_dir, "orders")), count_nulls=True)


def resolve_window(spark, sf_dir):
    return window_ops.resolved_window(table(spark, sf_dir, "orders"), ORDERS, AS_OF)


def resolve_window_clipped(spark, sf_dir):
    """The newest order date as an explicit watermark shortly before the cutoff."""
    orders = table(spark, sf_dir, "orders")
    newest = orders.agg(F.to_date(F.max("o_orderdate")).alias("watermark"))
    return window_ops.resolved_window(orders, ORDERS, date(2006, 10, 1), watermark=newest)


def resolve_window_watermark(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    mark = ledger_ops.watermark(derived_state(events)).agg(F.max("watermark").alias("watermark"))
    return window_ops.resolved_window(events, EVENTS, EVENTS_AS_OF, watermark=mark)


def resolve_window_none(spark, sf_dir):
    return window_ops.resolved_window(table(spark, sf_dir, "events"), EVENTS, AS_OF)


def window_plan(spark, sf_dir):
    return window_ops.window_plan(table(spark, sf_dir, "orders"), ORDERS, AS_OF)


def window_plan_counts(spark, sf_dir):
    return window_ops.window_plan_counts(table(spark, sf_dir, "orders"), ORDERS, AS_OF)


def _keyed(granularity: Granularity) -> Query:
    def query(spark, sf_dir):
        spec = TableSpec("events", pk="event_id", date_col="ts", granularity=granularity)
        keyed = export_ops.with_archive_key(table(spark, sf_dir, "events"), spec)
        return keyed.select("event_id", "archive_key")

    return query


def partition_key_month(spark, sf_dir):
    """Rows without a date get a key of their own."""
    keyed = export_ops.with_archive_key(orders_with_nulls(table(spark, sf_dir, "orders")), ORDERS)
    return keyed.select("o_orderkey", "o_custkey", "o_totalprice", "archive_key")


def rows_per_key(spark, sf_dir):
    return export_ops.rows_per_key(orders_with_nulls(table(spark, sf_dir, "orders")), ORDERS)


def safe_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", safe_key_of(F.col("props")).alias("safe_key"))


def null_violations(spark, sf_dir):
    return scan.null_violations(
        orders_with_nulls(table(spark, sf_dir, "orders")), ("o_orderkey", "o_custkey", "o_orderdate")
    )


def typed_projection(spark, sf_dir):
    """Widened integers, rescaled decimals, dates from timestamps, booleans from text."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "is_returned", F.when(F.col("l_returnflag") == "R", "True").otherwise(F.col("l_returnflag"))
    )
    target = T.StructType.fromDDL(
        "l_orderkey bigint, l_linenumber bigint, l_quantity int, l_extendedprice decimal(12,2), "
        "l_tax decimal(4,2), l_shipdate date, is_returned boolean, l_linestatus string"
    )
    return scan.typed_projection(lines, target)


def _exported(spark: SparkSession, rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, str, int]:
    """Write rows as an archive; the re-read archive, its folder and the rows the writer saw."""
    path = scratch_dir(spark, spec.name)
    stored = export_ops.archive_rows(rows, spec)
    stats = export_ops.write_archive(stored, spec, path)
    return export_ops.read_archive(spark, path, stored.schema), path, stats.rows


def export_partitioned(spark, sf_dir):
    rows = scan.window_scan(table(spark, sf_dir, "orders"), ORDERS, ALL_YEARS)
    return _exported(spark, rows, ORDERS)[0]


def manifest_counts(spark, sf_dir):
    rows = scan.window_scan(table(spark, sf_dir, "orders"), ORDERS, ALL_YEARS)
    archive, path, written = _exported(spark, rows, ORDERS)
    return (
        export_ops.manifest(archive, path)
        .groupBy("archive_key")
        .agg(F.sum("n_rows").alias("n_rows"))
        .withColumn("written_rows", F.lit(written).cast("long"))
    )


def rollover_files(spark, sf_dir):
    """No file is larger than the cap, and no key has fewer files than the cap demands.

    A key that adaptive execution split over tasks may have more.
    """
    orders = table(spark, sf_dir, "orders")
    cap = FILE_ROWS
    spec = TableSpec("orders", pk="o_orderkey", date_col="o_orderdate", max_rows_per_file=cap)
    archive, path, _ = _exported(spark, scan.window_scan(orders, spec, ALL_YEARS), spec)
    files = export_ops.manifest(archive, path).groupBy("archive_key")
    counted = files.agg(
        F.sum("n_rows").alias("n_rows"), F.max("n_rows").alias("largest"), F.count("*").alias("n_files")
    )
    return counted.select(
        "archive_key",
        "n_rows",
        (F.col("largest") <= cap).alias("within_cap"),
        (F.col("n_files") >= F.ceil(F.col("n_rows") / cap)).alias("enough_files"),
    )


def archive_scan_files(spark, sf_dir):
    """Read an export back from the list of its files, each file checked."""
    events = scan.window_scan(table(spark, sf_dir, "events"), EVENTS, EVENT_WINDOW)
    archive, path, _ = _exported(spark, events, EVENTS)
    files = export_ops.manifest(archive, path).select("file_path")
    return archive_scan(spark, files, archive.drop("archive_key").schema)


def reconcile_diff(spark, sf_dir):
    source, archive = damaged_orders(table(spark, sf_dir, "orders"))
    verdicts = reconcile_ops.diff(source, archive, ORDERS.pk)
    return verdicts.withColumn("mismatch_columns", F.array_join("mismatch_columns", ","))


def reconcile_summary(spark, sf_dir):
    source, archive = damaged_orders(table(spark, sf_dir, "orders"))
    return reconcile_ops.summarize(reconcile_ops.diff(source, archive, ORDERS.pk))


def reconcile_documents(spark, sf_dir):
    """Whole texts compared with their archived copies."""
    documents = table(spark, sf_dir, "documents")
    verdicts = reconcile_ops.diff(documents, damaged_documents(documents), ("doc_id",))
    return verdicts.withColumn("mismatch_columns", F.array_join("mismatch_columns", ","))


def reconcile_duplicates(spark, sf_dir):
    """A table whose key repeats: repeated keys are reported, the others compared."""
    lines = table(spark, sf_dir, "lineitem")
    return reconcile_ops.summarize(reconcile_ops.diff(lines, lines, LINE_KEY))


def first_mismatch(spark, sf_dir):
    """What the error of a failed reconcile names: the smallest key with a fault."""
    first = reconcile_ops.first_mismatch(reconcile_ops.diff(*damaged_orders(table(spark, sf_dir, "orders")), ORDERS.pk), ORDERS.pk)
    return first.withColumn("mismatch_columns", F.array_join("mismatch_columns", ","))


def missing_in_archive(spark, sf_dir):
    source, archive = damaged_orders(table(spark, sf_dir, "orders"))
    return reconcile_ops.missing_in_archive(source, archive, ORDERS.pk)


def missing_in_source(spark, sf_dir):
    source, archive = damaged_orders(table(spark, sf_dir, "orders"))
    return reconcile_ops.missing_in_source(source, archive, ORDERS.pk)


def set_equality(spark, sf_dir):
    return reconcile_ops.set_equality(*damaged_orders(table(spark, sf_dir, "orders")))


def duplicate_keys(spark, sf_dir):
    return reconcile_ops.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


def count_gates(spark, sf_dir):
    source, archive = damaged_orders(table(spark, sf_dir, "orders"))
    # An export that is said to have had the rows of all years, which neither side has.
    stated = scan.window_count(table(spark, sf_dir, "orders"), ORDERS, ALL_YEARS)
    exported = stated.select("n_rows").scalar()
    return reconcile_ops.count_gates(source, archive, ORDERS.pk, exported)


def delete_targets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    archived = scan.window_scan(orders, ORDERS, FIRST_WINDOW)
    return delete_ops.delete_targets(orders, archived, ORDERS.pk)


def delete_survivors(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    archived = scan.window_scan(orders, ORDERS, FIRST_WINDOW)
    return delete_ops.survivors(orders, archived, ORDERS, FIRST_WINDOW)


def delete_survivors_filter(spark, sf_dir):
    """Survivors of a proven window as a plain filter; rows without a date stay."""
    orders = orders_with_nulls(table(spark, sf_dir, "orders"))
    return delete_ops.survivors_of_window(orders, ORDERS.with_predicate(PREDICATE), MOST_YEARS)


def delete_batch_plan(spark, sf_dir):
    """Totals over the plan; where ranges begin depends on sampling."""
    plan = delete_ops.delete_batch_plan(table(spark, sf_dir, "orders"), ORDERS, MOST_YEARS, BATCH_ROWS)
    return plan.agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("first_pk").alias("first_pk"),
        F.max("last_pk").alias("last_pk"),
        (F.max("n_rows") <= BATCH_ROWS).alias("within_batch"),
        (F.sum(F.col("last_pk") - F.col("first_pk") + 1) <= F.max("last_pk") - F.min("first_pk") + 1).alias(
            "disjoint"
        ),
    )


def delete_batch_plan_lines(spark, sf_dir):
    """Every batch over a key of two columns that some line items share."""
    spec = TableSpec("lineitem", pk=LINE_KEY, date_col="l_shipdate")
    plan = delete_ops.global_batch_plan(table(spark, sf_dir, "lineitem"), spec, MOST_YEARS, BATCH_ROWS)
    bounds = [
        F.col(f"{end}_pk.{c}").alias(f"{end}_{c.removeprefix('l_')}") for end in ("first", "last") for c in LINE_KEY
    ]
    return plan.select("batch_no", *bounds, "n_rows", "splits_key", (F.col("n_rows") == BATCH_ROWS).alias("full"))


def restore_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    archive, _, _ = _exported(spark, scan.window_scan(orders, ORDERS, FIRST_WINDOW), ORDERS)
    current = delete_ops.survivors_of_window(orders, ORDERS, FIRST_WINDOW)
    return restore_ops.restore_union(current, archive.drop("archive_key"))


def ledger_fold(spark, sf_dir):
    return derived_state(table(spark, sf_dir, "events"))


def ledger_find(spark, sf_dir):
    state = derived_state(table(spark, sf_dir, "events"))
    return state.where((F.col("table_name") == "view") & (F.col("window_start") == F.lit(date(2024, 1, 10))))


def watermark(spark, sf_dir):
    return ledger_ops.watermark(derived_state(table(spark, sf_dir, "events")))


def file_lookup(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return restore_ops.lookup_files(given_files(events), derived_manifest(events))


def unknown_files(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return restore_ops.unknown_files(given_files(events), derived_manifest(events))


def restore_window_check(spark, sf_dir):
    return restore_ops.window_check(file_lookup(spark, sf_dir))


def restore_resolve(spark, sf_dir):
    """What a restore finds out about the named files, in one pass: unknown ones, windows and runs."""
    events = table(spark, sf_dir, "events")
    return restore_ops.resolve_files(given_files(events), derived_manifest(events))


def ledger_steps(spark, sf_dir):
    """For each event, whether its status may follow the one before it in the same window."""
    before = Window_.partitionBy(*restore_ops.WINDOW_KEY).orderBy("seq")
    steps = derived_events(table(spark, sf_dir, "events")).select(
        "seq", "status", F.lag("status").over(before).alias("status_before")
    )
    allowed = F.lit(False)
    for status, following in ledger_ops.FOLLOWS.items():
        names = [s.value for s in following]
        allowed = allowed | ((F.col("status_before") == status.value) & F.col("status").isin(names))
    begins = F.col("status") == ledger_ops.Status.STARTED.value
    return steps.withColumn("allowed", begins | F.coalesce(allowed, F.lit(False)))


def resolve_explicit_start(spark, sf_dir):
    """An early start, one that the cutoff clips, and the cutoff itself, which leaves nothing to archive."""
    orders = table(spark, sf_dir, "orders")
    starts = (date(1995, 3, 31), date(2001, 8, 15), date(2001, 10, 1))
    frames = [window_ops.resolved_window(orders, ORDERS, date(2006, 10, 1), explicit_start=s) for s in starts]
    return reduce(DataFrame.unionByName, frames)


def resolve_leap_day(spark, sf_dir):
    """Five years before a 29 February there is none."""
    return window_ops.resolved_window(table(spark, sf_dir, "orders"), ORDERS, date(2004, 2, 29))


def export_refuses_overwrite(spark, sf_dir):
    """A second export to the same place, of other rows: it is refused and the first one stays."""
    orders = table(spark, sf_dir, "orders")
    archive, path, _ = _exported(spark, scan.window_scan(orders, ORDERS, FIRST_WINDOW), ORDERS)
    others = export_ops.archive_rows(scan.window_scan(orders, ORDERS, MOST_YEARS), ORDERS)
    try:
        export_ops.write_archive(others, ORDERS, path)
        refused = False
    except AnalysisException as taken:
        refused = taken.getCondition() == "PATH_ALREADY_EXISTS"
    return archive.groupBy("archive_key").agg(F.count("*").alias("n_rows")).withColumn("refused", F.lit(refused))


def export_order_in_files(spark, sf_dir):
    """Rows of each key that stand behind a larger key in their part file."""
    rows = scan.window_scan(table(spark, sf_dir, "orders"), ORDERS, ALL_YEARS)
    archive, _, _ = _exported(spark, rows, ORDERS)
    placed = archive.select(
        "archive_key", "o_orderkey", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = F.lag("o_orderkey").over(Window_.partitionBy("file").orderBy("at"))
    behind = F.count_if(F.col("o_orderkey") < F.col("before"))
    placed = placed.withColumn("before", before).groupBy("archive_key")
    return placed.agg(F.count("*").alias("n_rows"), behind.alias("out_of_order"))


# -- whole jobs --------------------------------------------------------------


def _job(spark: SparkSession, rows: DataFrame, spec: TableSpec, **settings) -> tuple[CatalogTable, Retention]:
    root = scratch_dir(spark, f"job-{spec.name}")
    name = f"{spec.name}_{uuid.uuid4().hex}"
    held = CatalogTable.create(spark, name, rows, spec, location=f"{root}/table")
    jobs = Retention(spark, ledger_ops.Ledger(spark, f"{root}/ledger"), f"{root}/archive", **settings)
    return held, jobs


def archive_window_job(spark, sf_dir):
    """One run with an extra predicate, and what the ledger says afterwards."""
    spec = ORDERS.with_predicate(PREDICATE)
    held, jobs = _job(spark, table(spark, sf_dir, "orders"), spec)
    jobs.archive_next(held, spec, AS_OF)
    left = held.read().agg(F.count("*").alias("n")).scalar()
    return jobs.ledger.state("orders").select(
        *restore_ops.WINDOW_KEY,
        "status",
        "exported",
        "reconciled",
        "deleted",
        left.alias("rows_left"),
    )


def export_transform(spark, sf_dir):
    """A window exported through a transform that changes values, as its files hold it; the live side is proved through it too."""

    def masked(rows: DataFrame) -> DataFrame:
        price = F.floor("o_totalprice").cast("double")
        return rows.withColumns({"o_totalprice": price, "o_orderpriority": F.lower("o_orderpriority")})

    held, jobs = _job(spark, table(spark, sf_dir, "orders"), ORDERS)
    record = jobs.archive_window(held, ORDERS, FIRST_WINDOW, AS_OF, transform=masked)
    archive = export_ops.read_archive(spark, record.archive_path, T.StructType.fromJson(json.loads(record.archive_schema)))
    return archive.drop("archive_key").withColumn("status", F.lit(record.status.value))


class _Swapped(LiveTable):
    """A live table whose owner changes it between the proof and the first delete."""

    def delete_window(self, *given):
        self.swap()
        return super().delete_window(*given)


def live_delete_swap(spark, sf_dir):
    """Between proof and delete one row is replaced and one changed: both stay, the archived rows go."""
    orders = table(spark, sf_dir, "orders")
    store = RowFiles(scratch_dir(spark, "live-orders"), "o_orderkey", orders.schema)
    store.fill(scan.window_scan(orders, ORDERS, FIRST_WINDOW))
    outside = delete_ops.survivors_of_window(orders, ORDERS, FIRST_WINDOW)
    held = _Swapped(lambda: outside.unionByName(store.read(spark)), store.delete_rows, None)

    def swap():
        first, second = (
            store.get(r.o_orderkey) for r in store.read(spark).select("o_orderkey").orderBy("o_orderkey").limit(2).collect()
        )
        store.put({**first, "o_orderkey": -first["o_orderkey"] - 1})
        store.remove(first["o_orderkey"])
        store.put({**second, "o_totalprice": second["o_totalprice"] + 1})

    object.__setattr__(held, "swap", swap)
    jobs = Retention(spark, ledger_ops.Ledger(spark, scratch_dir(spark, "ledger")), scratch_dir(spark, "archive"))
    try:
        jobs.archive_window(held, ORDERS, FIRST_WINDOW, AS_OF)
    except RetentionError:
        pass
    status = jobs.ledger.find("orders", FIRST_WINDOW).status.value
    return held.read().withColumn("status", F.lit(status))


def archive_predicate_leftovers(spark, sf_dir):
    """Every order and where it is after a run with an extra predicate."""
    spec = ORDERS.with_predicate(PREDICATE)
    held, jobs = _job(spark, table(spark, sf_dir, "orders"), spec)
    record = jobs.archive_window(held, spec, MOST_YEARS, EVENTS_AS_OF)
    schema = T.StructType.fromJson(json.loads(record.archive_schema))
    archive = export_ops.read_archive(spark, record.archive_path, schema)
    here, there = (F.lit(x).alias("place") for x in ("table", "archive"))
    return held.read().select("o_orderkey", here).unionByName(archive.select("o_orderkey", there))


def delete_after_drift(spark, sf_dir):
    """The owner removes rows between proof and delete: the delete is refused, a rerun archives what is left."""
    held, jobs = _job(spark, table(spark, sf_dir, "orders"), ORDERS)
    jobs.export_window(held, ORDERS, FIRST_WINDOW)
    jobs.reconcile_window(held, ORDERS, FIRST_WINDOW)
    owners = ORDERS.with_predicate("o_orderpriority LIKE '1%'")
    gone = scan.window_count(held.read(), owners, FIRST_WINDOW).first().n_rows
    held.delete_window(owners, FIRST_WINDOW, gone)
    try:
        jobs.delete_window(held, ORDERS, FIRST_WINDOW)
    except RetentionError:
        pass
    refused = jobs.ledger.find("orders", FIRST_WINDOW).status.value
    jobs.archive_window(held, ORDERS, FIRST_WINDOW, AS_OF)
    left = held.read().agg(F.count("*").alias("n")).scalar()
    return jobs.ledger.state("orders").select(
        F.lit(refused).alias("first_status"), "status", "exported", "reconciled", "deleted", left.alias("rows_left")
    )


def delete_skipped(spark, sf_dir):
    """A dry run, and a run with deletes switched off: nothing goes, and the ledger says how much would."""
    rows = table(spark, sf_dir, "orders")
    states = []
    for settings, dry_run in (({}, True), ({"delete_enabled": False}, False)):
        held, jobs = _job(spark, rows, ORDERS, **settings)
        jobs.archive_window(held, ORDERS, FIRST_WINDOW, AS_OF, dry_run=dry_run)
        left = held.read().agg(F.count("*").alias("n")).scalar()
        state = jobs.ledger.state("orders")
        states.append(state.select("status", "error_message", "reconciled", "deleted", left.alias("rows_left")))
    return reduce(DataFrame.unionByName, states)


def _round_trip(spark: SparkSession, rows: DataFrame) -> tuple[CatalogTable, int, Record]:
    """Archive and restore all events; the table, the rows left in between, and the last record."""
    held, jobs = _job(spark, rows, EVENTS)
    record = jobs.archive_window(held, EVENTS, EVENT_WINDOW, EVENTS_AS_OF)
    left = held.read().count()
    files = jobs.ledger.output_files("events", record.window).select("file_path")
    return held, left, jobs.restore_files(held, EVENTS, files)


def restore_small_integers(spark, sf_dir):
    """A 16-bit column is stored as 32 bits and comes back as 16."""
    events = table(spark, sf_dir, "events").withColumn("n_props", F.length("props").cast("smallint"))
    return _round_trip(spark, events)[0].read()


def restore_counts(spark, sf_dir):
    """Rows of the table between archive and restore and afterwards, and what the ledger counted."""
    held, left, record = _round_trip(spark, table(spark, sf_dir, "events"))
    counts = held.read().agg(F.count("*").alias("rows_after"))
    return counts.select(
        F.lit(left).cast("long").alias("rows_left"),
        F.lit(record.deleted).cast("long").alias("deleted"),
        F.lit(record.restored).cast("long").alias("restored"),
        "rows_after",
    )


def restore_resumed(spark, sf_dir):
    """A restore that ended after its insert and before its record is recorded when it is asked for again."""
    held, jobs = _job(spark, table(spark, sf_dir, "orders"), ORDERS)
    record = jobs.archive_window(held, ORDERS, FIRST_WINDOW, AS_OF)
    schema = T.StructType.fromJson(json.loads(record.archive_schema))
    jobs.ledger.record("orders", FIRST_WINDOW, ledger_ops.Status.RESTORE_STARTED, record.run_token, after=record)
    held.insert(export_ops.read_archive(spark, record.archive_path, schema).drop("archive_key"), ORDERS)
    done = jobs.restore_files(held, ORDERS, jobs.ledger.output_files("orders", FIRST_WINDOW).select("file_path"))
    return held.read().select(
        "*", F.lit(done.status.value).alias("status"), F.lit(done.restored).cast("long").alias("restored")
    )


def archive_walk(spark, sf_dir):
    """Window after window up to the cutoff, a year each; then the table that is left."""
    held, jobs = _job(spark, table(spark, sf_dir, "orders"), ORDERS, window_months=12)
    jobs.archive_pending(held, ORDERS, AS_OF)
    return held.read()


def restore_roundtrip(spark, sf_dir):
    """Archive all events, delete them, restore them from their files; the table afterwards."""
    return _round_trip(spark, table(spark, sf_dir, "events"))[0].read()


QUERIES: dict[str, Query] = {
    "window_scan": window_scan,
    "window_scan_predicate": window_scan_predicate,
    "window_count": window_count,
    "oldest_date": oldest_date,
    "schema_discovery": schema_discovery,
    "resolve_window": resolve_window,
    "resolve_window_clipped": resolve_window_clipped,
    "resolve_window_watermark": resolve_window_watermark,
    "resolve_window_none": resolve_window_none,
    "window_plan": window_plan,
    "window_plan_counts": window_plan_counts,
    "partition_key_day": _keyed(Granularity.EXACT_DATE),
    "partition_key_month": partition_key_month,
    "partition_key_year": _keyed(Granularity.YEAR),
    "partition_key_none": _keyed(Granularity.NONE),
    "rows_per_key": rows_per_key,
    "safe_key": safe_key,
    "null_violations": null_violations,
    "typed_projection": typed_projection,
    "export_partitioned": export_partitioned,
    "manifest_counts": manifest_counts,
    "rollover_files": rollover_files,
    "archive_scan": archive_scan_files,
    "reconcile_diff": reconcile_diff,
    "reconcile_summary": reconcile_summary,
    "reconcile_documents": reconcile_documents,
    "reconcile_duplicates": reconcile_duplicates,
    "first_mismatch": first_mismatch,
    "missing_in_archive": missing_in_archive,
    "missing_in_source": missing_in_source,
    "set_equality": set_equality,
    "duplicate_keys": duplicate_keys,
    "count_gates": count_gates,
    "delete_targets": delete_targets,
    "delete_survivors": delete_survivors,
    "delete_survivors_filter": delete_survivors_filter,
    "delete_batch_plan": delete_batch_plan,
    "delete_batch_plan_lines": delete_batch_plan_lines,
    "restore_union": restore_union,
    "restore_roundtrip": restore_roundtrip,
    "ledger_fold": ledger_fold,
    "ledger_find": ledger_find,
    "watermark": watermark,
    "file_lookup": file_lookup,
    "unknown_files": unknown_files,
    "restore_window_check": restore_window_check,
    "restore_resolve": restore_resolve,
    "ledger_steps": ledger_steps,
    "resolve_explicit_start": resolve_explicit_start,
    "resolve_leap_day": resolve_leap_day,
    "export_refuses_overwrite": export_refuses_overwrite,
    "export_order_in_files": export_order_in_files,
    "archive_predicate_leftovers": archive_predicate_leftovers,
    "delete_after_drift": delete_after_drift,
    "delete_skipped": delete_skipped,
    "restore_small_integers": restore_small_integers,
    "restore_counts": restore_counts,
    "archive_window_job": archive_window_job,
    "archive_walk": archive_walk,
    "export_transform": export_transform,
    "live_delete_swap": live_delete_swap,
    "restore_resumed": restore_resumed,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve the first window, export it, re-read it, compare; per key the rows and the faults."""
    orders = table(spark, sf_dir, "orders")
    window = window_ops.resolve_window(orders, ORDERS, AS_OF).window
    live = scan.window_scan(orders, ORDERS, window)
    archive, _, _ = _exported(spark, live, ORDERS)
    verdicts = reconcile_ops.diff(export_ops.archive_rows(live, ORDERS), archive.drop("archive_key"), ORDERS.pk)
    faults = verdicts.where(F.col("verdict") != reconcile_ops.MATCH)
    keyed = export_ops.with_archive_key(live, ORDERS).select("o_orderkey", "archive_key")
    counts = [
        export_ops.rows_per_key(live, ORDERS).withColumnRenamed("n_rows", "source_rows"),
        archive.groupBy("archive_key").agg(F.count("*").alias("archive_rows")),
        keyed.join(faults, "o_orderkey").groupBy("archive_key").agg(F.count("*").alias("faults")),
    ]
    joined = reduce(lambda left, right: left.join(right, "archive_key", "left"), counts)
    return joined.select(
        "archive_key", "source_rows", "archive_rows", F.coalesce("faults", F.lit(0)).alias("mismatches")
    )
