"""Small tables the job tests run on."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal

from coldshelf import CatalogTable, Ledger, Retention, TableSpec, Window
from coldshelf.session import scratch_dir

AS_OF = date(2026, 1, 15)
OLD = Window(date(2015, 1, 1), date(2015, 5, 1))
NEXT = Window(date(2015, 5, 1), date(2015, 9, 1))
ORDER_COLUMNS = (
    "order_id bigint, customer_id bigint, fye date, order_amount decimal(12,2), "
    "status string, created_at timestamp_ntz"
)
SPEC = TableSpec("test_orders", pk="order_id", required=("order_id", "customer_id", "fye", "order_amount"))


def order(key: int, fye: date, amount: str):
    midnight = datetime.combine(fye, datetime.min.time())
    return (key, 9000 + key * 7 % 11, fye, Decimal(amount), "CLOSED", midnight)


def order_rows():
    """30 rows in the old window, 10 just after it, 10 recent ones."""
    dates = [OLD.start + timedelta(days=3 * i) for i in range(30)]
    dates += [OLD.end + timedelta(days=5 * i) for i in range(10)]
    dates += [AS_OF - timedelta(days=30 * i) for i in range(10)]
    amounts = ["41.50"] * 30 + ["7.25"] * 10 + ["0.99"] * 10
    return [order(i + 1, d, a) for i, (d, a) in enumerate(zip(dates, amounts))]


def orders(spark, rows=None):
    return spark.createDataFrame(order_rows() if rows is None else rows, ORDER_COLUMNS)


def stored(spark, root, rows, spec):
    """An external table below ``root``."""
    return CatalogTable.create(spark, f"{spec.name}_{uuid.uuid4().hex}", rows, spec, location=f"{root}/table")


class Shelf:
    """One table with its ledger and archive, in a fresh folder."""

    def __init__(self, spark, rows=None, spec=SPEC, **settings):
        self.root = scratch_dir(spark, "test")
        self.spec = spec
        self.table = stored(spark, self.root, orders(spark, rows), spec)
        self.ledger = Ledger(spark, f"{self.root}/ledger")
        self.jobs = Retention(spark, self.ledger, f"{self.root}/archive", **settings)

    def archive(self, window=OLD, **options):
        return self.jobs.archive_window(self.table, self.spec, window, AS_OF, **options)

    def files(self, window=OLD):
        return [r.file_path for r in self.ledger.output_files(self.spec.name, window).collect()]

    def restore(self, files, **options):
        return self.jobs.restore_files(self.table, self.spec, files, **options)

    def rows(self):
        return sorted(tuple(r) for r in self.table.read().collect())

    def status(self, window=OLD):
        return self.ledger.find(self.spec.name, window).status

    def statuses(self, window=OLD):
        events = self.ledger.events(self.spec.name).where(f"window_start = date'{window.start}'")
        return [r.status for r in events.orderBy("seq").collect()]
