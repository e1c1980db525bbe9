import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check_oracle import duckdb_tables, session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duckdb_con():
    return duckdb_tables(SF_DIR)


@pytest.fixture
def value(spark):
    """Evaluate a Column over one row of named string values."""

    def evaluate(make, *texts):
        names = [f"c{i}" for i in range(len(texts))]
        schema = ", ".join(f"{name} string" for name in names)
        df = spark.createDataFrame([tuple(texts)], schema)
        return df.select(make(*names).alias("v")).first()["v"]

    return evaluate


@pytest.fixture
def plan():
    """The physical plan as text."""

    def explain(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return explain
