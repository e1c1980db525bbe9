"""Python workers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def find_package(spark: SparkSession) -> None:
    """Workers look for this package where the driver has it, if told nowhere else."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
