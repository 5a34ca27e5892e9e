import pytest

from tallyward.llm.common import ship

#: NULLs, empty and white texts, ties and repeated rows; one long text.
DOCS = [
    (1, "one two three four. Five six seven", "a"),
    (1, "one two three four. Five six seven", "a"),
    (2, "One two three four. Five six seven", None),
    (3, None, "b"),
    (4, "", "b"),
    (None, "nobody@example.com wrote +1 (555) 555-5555", "c"),
    (6, " \t\n ", "c"),
    (7, "word and more. " * 40_000, "d"),
    (8, "x" * 60_000, "d"),
    (9, "a  b c <|endoftext|> d\n\ne  ", "d"),
]
SCHEMA = "doc_id long, text string, fp string"


@pytest.fixture(scope="session")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(DOCS, SCHEMA).withColumnRenamed("fp", "component_id")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    ship(spark)
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
