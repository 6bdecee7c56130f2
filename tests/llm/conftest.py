import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


from brute import SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(row) for row in rows]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make
