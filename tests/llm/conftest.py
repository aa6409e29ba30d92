import pytest


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    from plumbline.llm.catalog import ship

    ship(spark)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture
def odd(spark):
    """Documents with nulls, ties, repeated rows, long texts and names that the operators use inside."""
    long = "word other third. " * 20_000
    rows = [
        (1, None, "a", 1), (2, "", "b", 2), (3, "   \n\t ", None, 3), (4, "one", "d", 4), (4, "one", "d", 4),
        (None, "no id here", "e", 5), (5, long, "f", 6), (6, "one", None, None),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, digest string, hash bigint")


@pytest.fixture
def none(odd):
    return odd.limit(0)
