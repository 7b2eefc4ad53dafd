import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make
