import pytest
from pyspark.sql import SparkSession

from footfall.session import ship_package

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def shipped(spark) -> SparkSession:
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def sf001() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs001(shipped, sf001):
    return shipped.read.parquet(f"{sf001}/documents.parquet")


@pytest.fixture(scope="session")
def rows001(docs001):
    return [(r["doc_id"], r["text"]) for r in docs001.select("doc_id", "text").collect()]


LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
# nulls, empty and blank texts, a very long text, repeated rows, equal ids, equal texts
EDGE = [(1, None), (2, ""), (3, " \n\t "), (None, None), (None, "a null id with words"),
        (4, LONG), (5, LONG), (5, LONG), (6, "one"), (6, "two texts of one id"),
        (7, f"begin {PASSAGE} end"), (8, f"{PASSAGE}"), (9, f"other begin {PASSAGE} other end"),
        (None, f"null {PASSAGE}"), (10, "ünï cödé \U0001F600 ſ K"), (11, "x y z")]


@pytest.fixture(scope="session")
def edge(shipped):
    """Edge rows with extra columns whose names clash with those that operators make."""
    df = shipped.createDataFrame(EDGE, SCHEMA)
    return df.selectExpr("*", "cast(null as string) as lang", "'s' as source",
                         "cast(length(text) as long) as n_chars", "1 as n_words", "2 as start",
                         "3 as fp", "4 as value", "5 as row")


@pytest.fixture(scope="session")
def empty(shipped):
    return shipped.createDataFrame([], "doc_id long, text string, lang string")
