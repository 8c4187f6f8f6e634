import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[2])]
from odd_documents import DOCS, odd_texts, rows


@pytest.fixture(scope="session")
def odd():
    return odd_texts()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    return spark.createDataFrame(rows(odd), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
