"""coldshelf: window-by-window table retention on Spark.

Select aged rows in one date window, export them to partitioned Parquet,
prove the files equal the live rows column by column, publish the table
without those rows, and put them back from the named files on request.
"""

from coldshelf.plans.jobs import Retention, RetentionError, RetentionRefused
from coldshelf.plans.ledger import Ledger, Status
from coldshelf.plans.windows import plan_windows, resolve_window
from coldshelf.sources.catalog import CatalogTable
from coldshelf.sources.live import LiveTable
from coldshelf.spec import Granularity, TableSpec, Window

__all__ = [
    "CatalogTable",
    "Granularity",
    "Ledger",
    "LiveTable",
    "Retention",
    "RetentionError",
    "RetentionRefused",
    "Status",
    "TableSpec",
    "Window",
    "plan_windows",
    "resolve_window",
]
