from compare import differences, duck
from helpers import SF_DIR

import __spark_entry__ as entry
from coldshelf.llm import queries


def test_all_operators_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and set(queries.QUERIES) <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_queries_equal_their_sql(spark):
    con = duck(SF_DIR)
    for name, sql in queries.ORACLE.items():
        assert differences(queries.QUERIES[name](spark, SF_DIR), con, sql) is None
