"""Article frames over a ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS_PER_YEAR = 8760


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give text work enough tasks when the input files are too few to.

    Rows move only if the scan has fewer partitions than the cluster has cores,
    that is for small inputs; a large table is read as its files lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table with the columns of an article."""
    hour = F.expr(f"make_dt_interval(0, cast(pmod(doc_id, {HOURS_PER_YEAR}) as int))")
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    author = F.when(F.col("doc_id") % 7 != 0, F.concat(F.upper("lang"), F.lit(" desk")))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ID"),
        title.alias("Title"),
        F.concat(F.lit("https://example.com/"), F.col("doc_id")).alias("Url"),
        F.col("source").alias("Section"),
        (start + hour).cast("string").alias("Published Date"),
        author.alias("Author"),
        F.col("text").alias("Content"),
    )


def spread_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(articles(spark, sf_dir), "ID")
