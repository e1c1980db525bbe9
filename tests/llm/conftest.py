import os
from pathlib import Path

import pytest
from cases import ODD_TEXTS

ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture
def odd(spark):
    """Odd documents with further columns, some named like the operators' own."""
    rows = [(i, t, "en", "s", 1, 2, "3") for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, id long, bits long, ids string"
    )


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
