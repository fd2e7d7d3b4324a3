import pytest

SF_MID = "/root/testdata/sf0.01"

ROWS = [
    (5, "One two three, four. FIVE six!\nseven eight"), (1, None), (2, ""), (3, " \n\t "), (4, "word " * 3000),
    (9, "same text here"), (7, "same text here"), (7, "same text here"), (None, "text without an id"), (8, "é à Ünïcode 漢字 🙂."),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """NULLs, empty and long texts, repeated rows, and extra columns with clashing names."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "1 AS `row`", "'x' AS fp", "2 AS `id`", "3 AS `n`", "'t' AS word")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def mid(spark):
    """(documents of sf0.01, its rows)."""
    df = spark.read.parquet(f"{SF_MID}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
