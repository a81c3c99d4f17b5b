"""A folder of small files that hold rows by key: a table outside Spark for trying ``LiveTable`` without a database.

Rows lie in pages, by ranges of keys. A file of a page adds rows,
removes versions of rows that other files added, or both; it is never changed.
So a write takes effect as a whole, repeating one does no harm, and two tasks
that delete from one page do not undo each other.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, GroupedData, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: The last bits of a key that tell the rows of a page apart.
PAGE_BITS = 15
_PAGE = "_page"

Row = dict[str, Any]


def _by_page(rows: DataFrame) -> GroupedData:
    """Grouped in as many tasks as the session sets: by its bytes, adaptive execution takes this for the work of one."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), _PAGE).groupBy(_PAGE)


class RowFiles:
    """Rows are named by one integer column; a row that is put replaces the one of its key."""

    def __init__(self, folder: str, key: str, schema: T.StructType):
        self.folder, self.key, self.schema = folder.rstrip("/"), key, schema

    def fill(self, rows: DataFrame) -> int:
        """Put the rows into the folder, in parallel; returns how many."""
        token = uuid.uuid4().hex

        def run(page: pa.Table) -> pa.Table:
            # The same name when a task runs again: its rows are not there twice.
            self._put(page.select(names).to_pylist(), token)
            return pa.table({"n": [page.num_rows]})

        names = rows.columns
        pages = _by_page(rows.withColumn(_PAGE, F.shiftright(self.key, PAGE_BITS)))
        return pages.applyInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def put(self, row: Row) -> None:
        self._put([row], uuid.uuid4().hex)

    def get(self, key: int) -> Row | None:
        return next((row for row, _ in self._held(key >> PAGE_BITS).get(key, [])), None)

    def remove(self, key: int) -> None:
        self._write(key >> PAGE_BITS, uuid.uuid4().hex, [], [(of, key) for _, of in self._held(key >> PAGE_BITS).get(key, [])])

    def read(self, spark: SparkSession) -> DataFrame:
        files, folder = pyarrow.fs.FileSystem.from_uri(self.folder)
        files.create_dir(folder, recursive=True)

        def run(page: pa.Table) -> pa.Table:
            held = self._live(zip(page.column("path").to_pylist(), page.column("content").to_pylist()))
            return pa.Table.from_pylist([row for versions in held.values() for row, _ in versions], schema=arrow)

        arrow = to_arrow_schema(self.schema)
        held = spark.read.format("binaryFile").option("pathGlobFilter", "*.rows").option("recursiveFileLookup", "true")
        page = F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias(_PAGE)
        return _by_page(held.load(self.folder).select("path", "content", page)).applyInArrow(run, self.schema)

    def delete_rows(self, archived: pa.Table) -> int:
        """Remove the rows that equal an archived one; how many of the keys are left. Fits ``LiveTable``."""
        left = 0
        for page, rows in groupby(sorted(archived.to_pylist(), key=self._key), lambda row: self._key(row) >> PAGE_BITS):
            held, gone = self._held(page), []
            for row in rows:
                versions = held.get(self._key(row), [])
                same = [of for kept, of in versions if all(kept[c] == v for c, v in row.items())]
                gone += [(of, self._key(row)) for of in same]
                left += len(same) < len(versions)
            self._write(page, uuid.uuid4().hex, [], gone)
        return left

    # -- inside ------------------------------------------------------------

    def _key(self, row: Row) -> int:
        return row[self.key]

    def _put(self, rows: list[Row], token: str) -> None:
        """Add rows of one page."""
        page, rows = self._key(rows[0]) >> PAGE_BITS, list({self._key(row): row for row in rows}.values())
        held = self._held(page)
        gone = {(of, key) for key in map(self._key, rows) for _, of in held.get(key, []) if of != token}
        self._write(page, token, rows, sorted(gone))

    def _write(self, page: int, token: str, rows: list[Row], gone: list[tuple[str, int]]) -> None:
        if not rows and not gone:
            return
        files, folder = self._place(page)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/_{token}") as out:
            out.write(pickle.dumps((rows, gone)))
        files.move(f"{folder}/_{token}", f"{folder}/{token}.rows")

    def _held(self, page: int) -> dict[int, list[tuple[Row, str]]]:
        files, folder = self._place(page)
        found = files.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))

        def contents() -> Iterator[tuple[str, bytes]]:
            for path in sorted(f.path for f in found if f.path.endswith(".rows")):
                with files.open_input_stream(path) as held:
                    yield path, held.read()

        return self._live(contents())

    def _live(self, contents: Iterable[tuple[str, bytes]]) -> dict[int, list[tuple[Row, str]]]:
        """For each key of a page the rows that its files hold, with the name of the file that added each."""
        added, removed = [], set()
        for path, content in contents:
            rows, gone = pickle.loads(content)
            added.append((path.rsplit("/", 1)[-1].removesuffix(".rows"), rows))
            removed.update(gone)
        held: dict[int, list[tuple[Row, str]]] = {}
        for token, rows in added:
            for row in rows:
                if (token, self._key(row)) not in removed:
                    held.setdefault(self._key(row), []).append((row, token))
        return held

    def _place(self, page: int) -> tuple[pyarrow.fs.FileSystem, str]:
        files, path = pyarrow.fs.FileSystem.from_uri(self.folder)
        return files, f"{path}/page-{page}"
