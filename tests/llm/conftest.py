import pytest

from lapline.llm.common import ship_package

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture()
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows and extra columns with names the operators use."""
    rows = [
        (1, "the cat sat on the mat", "en", "a", 22, "x", 1.0, 5),
        (1, "the cat sat on the mat", "en", "a", 22, "x", 1.0, 5),
        (2, None, "en", None, None, None, None, None),
        (None, "der hund und die katze", "de", "b", 21, "y", 2.0, 6),
        (None, None, None, None, None, None, None, None),
        (3, "", None, "a", 0, "", 0.0, 0),
        (4, "  \t\n ", "de", "", 5, "", 0.0, 0),
        (5, "word " * 30_000, "en", "a", 150_000, "", 0.0, 0),
        (6, "x" * 100_000, "de", "c", 100_000, "", 0.0, 0),
        (7, "1234 5678 !!", "en", "c", 12, "", 0.0, 0),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double, row long")


@pytest.fixture()
def no_documents(spark, documents):
    return documents.limit(0)
