import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, `__key` string, h long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"word{i % 977} alpha beta" for i in range(20_000))
    line = "a shared line that has well over forty characters in it"
    rows = [(1, "Hello World this is text", "en", "a"), (2, "hello world THIS is text", "en", "a"), (2, "hello world THIS is text", "en", "a"),
            (None, "hello world this is text", "en", None), (3, None, None, "b"), (4, "", "en", "b"), (5, "   \n\t\n", None, None),
            (6, long, "en", "c"), (7, "123 456 !!!", "de", "c"), (8, "ÄÖÜ straße für die Leute", "de", "b"), (None, None, None, None)]
    rows += [(10 + i, f"{line}\nunique {i}", "en", "d") for i in range(7)]
    return spark.createDataFrame([(*r, 1, 7, "k", 3) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
