import os

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    from tidewatch.llm.common import importable

    importable(spark)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null and empty texts, white space, ties, repeated rows, a null id, a very long text, extra columns."""
    long = " ".join(f"word{i % 977} und{i % 31}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 1), (2, "the cat sat on the mat and looked at the dog", "en", "a", 1),
        (2, "the cat sat on the mat and looked at the dog", "en", "a", 1), (3, None, "en", None, None), (4, "", "en", "a", 0), (5, " \t\n ", None, "a", 3),
        (6, long, "de", "b", 9), (7, long + " ende", "de", "b", 9), (None, "ohne nummer aber mit text", "de", "b", 2), (8, "12 34 !!", "en", "b", 8),
        (9, "x", "fr", "c", 1), (10, "mail joe@example.com or +1 (555) 123-4567, 10.0.0.1, 4111 1111 1111 1111", "en", "c", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "doc_id AS uid", "'x' AS component", "1 AS n", "text AS payload")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    return path
