"""Small tables of documents, and folders of them as a query reads them."""

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratalake.sources.shared import fresh_folder

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def folder(spark):
    """Writes tables to a new folder: folder(documents=frame, ...) -> path."""

    def write(**tables):
        path = fresh_folder(spark, f"tables-{uuid.uuid4().hex[:6]}")
        for name, rows in tables.items():
            rows.write.parquet(f"{path}/{name}.parquet")
        return path

    return write


@pytest.fixture
def clash():
    """Adds columns whose names an operator might use itself."""

    def add(docs):
        names = "score place fp fingerprint component_id spans n_tokens h pos window item_id start keep_id rate n u".split()
        return docs.withColumns({n: F.lit("x") for n in names})

    return add
