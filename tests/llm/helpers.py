"""Small tables with every awkward case, and the given tables in memory."""

import duckdb

SF_DIR = "/root/testdata/sf0.001"


def rows(name: str, columns: str) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet'").fetchall()


ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "word",
    "two words",
    "!!! ??? ...",
    "Ünïcödé tèxt — “quotes” 日本語 🙂 it's  double  spaces\n\n\tand tabs. ",
    "the same text twice, the same text twice",
    "the same text twice, the same text twice",
    "x" * 5000,
    "long text with many words " * 4000,
]


def odd_documents(spark, ids=None):
    """Documents with nulls in every column, repeats, ties, and columns whose names operators use themselves."""
    ids = list(range(len(ODD_TEXTS) - 2)) + [None, 3] if ids is None else ids
    data = [
        (i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src", None, "mine", 1.5)
        for k, (i, t) in enumerate(zip(ids, ODD_TEXTS))
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id string, score double"
    return spark.createDataFrame(data, schema)


def nothing(frame):
    return frame.where("false")
