"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Only settings whose defaults do not suit the jobs; AQE itself is on by default.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Part files of an export follow this size, so 64 MB would be too small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench; ``shared`` becomes ``spark.checkpoint.dir``
    and holds managed tables."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("coldshelf")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared).config("spark.sql.warehouse.dir", f"{shared}/warehouse")
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="coldshelf-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below the shared one named by ``spark.checkpoint.dir``.

    Where no folder is named, a local session, whose tasks all run on this
    machine, gets one that goes when the process ends; any other is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/coldshelf/{label}-{uuid.uuid4().hex}"


def numbered_folders(spark: SparkSession, parent: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><n>`` below ``parent``, on any store that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [status.getPath().getName() for status in found]
    return [int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit()]
