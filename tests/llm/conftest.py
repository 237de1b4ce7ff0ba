import pytest
from llm_corpus import CLASHES, SCHEMA, corpus


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The documents with extra columns named like those the operators make."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in CLASHES})
