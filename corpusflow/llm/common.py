"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources.scratch import scratch_path

#: Characters that separate words.
SPACE_CLASS = r"\x20\x09-\x0D"
#: Largest vocabulary file that is sent to every executor.
MAX_VOCABULARY_BYTES = 64 << 20


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def workers_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, if told nowhere else."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id`` and ``text`` alone; a null text is empty."""
    workers_find_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows out when the scan has fewer partitions than the cluster has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def vocabulary_bytes(path: str) -> bytes:
    """A tokenizer file, whose size is fixed and checked, for a broadcast."""
    data = Path(path).read_bytes()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes, limit {MAX_VOCABULARY_BYTES}")
    return data


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8, without decoding it."""
    return batch.column(name).cast(pa.large_binary()).to_pylist()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def sized(df: DataFrame, row_bytes: int, limit: int = 16 << 20) -> DataFrame:
    """Marked for a broadcast if its rows are small enough, else for a merge join.

    ``df`` is stored, and no row takes more than ``row_bytes`` in memory.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df.hint("merge")
