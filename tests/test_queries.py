import pytest

import __spark_entry__ as entry
from compare import differences, duck
from coldshelf.oracle import ORACLE
from coldshelf.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, con, ORACLE[name]) is None


def test_flagship_finds_no_fault(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4
    assert all(r.source_rows == r.archive_rows > 0 and r.mismatches == 0 for r in rows)
