import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(helpers.rows(), helpers.DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], helpers.DOCS)
