"""Folders bucketed by keys: joins of two of them on these keys move no rows.

Spark keeps the buckets of a folder in the catalog.  An entry is made for as long as it
takes to write the folder or to resolve a frame over it, and leaves no trace.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpusflow.sources.scratch import without_shuffles


def _name() -> str:
    return f"corpusflow_{uuid.uuid4().hex}"


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, in_buckets: bool = False
) -> None:
    """One file for each bucket, its rows sorted by the keys.

    ``in_buckets``: each partition of ``df`` is a bucket already, so no row is moved.
    """
    name = _name()
    dealt = df if in_buckets else df.repartition(buckets, *keys)
    dealt = dealt.sortWithinPartitions(*keys)
    writer = dealt.write.format("parquet").bucketBy(buckets, list(keys)).sortBy(list(keys))
    try:
        with without_shuffles(df.sparkSession):
            writer.option("compression", "zstd").option("path", path).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The rows of such a folder, of which Spark knows how they lie."""
    name = _name()

    def quoted(text: str) -> str:
        return "`" + text.replace("`", "``") + "`"

    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(map(quoted, keys))
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        table = spark.table(name)
        table.schema  # resolves the frame, which then needs no catalog
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return table
