"""CSV and JSON files of articles, topic metadata and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusflow import schema
from corpusflow.operators import stats
from corpusflow.sources import csv_records

# Quotes and line breaks inside article texts stay inside their field, and
# nothing is trimmed.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write articles as CSV; token arrays become JSON text."""
    texts = {
        field.name: F.to_json(F.col(f"`{field.name}`"))
        for field in df.schema.fields
        if isinstance(field.dataType, ArrayType)
    }
    flat = df.withColumns(texts) if texts else df
    flat.write.mode(mode).options(**_CSV).csv(path)


def read_articles_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read articles from CSV; the known columns get their types by name.

    Large files are read by many tasks, although fields may hold line breaks.
    """
    names = spark.read.options(**_CSV, multiLine=True).csv(path).columns
    listed = ", ".join("`" + name.replace("`", "``") + "` string" for name in names)
    options = {k: str(v) for k, v in _CSV.items() if k not in ("header", "lineSep")}
    rows = csv_records.csv_records(spark, path).filter("not header and record <> ''")
    raw = rows.select(F.from_csv("record", listed, options).alias("r")).select("r.*")

    def typed(name: str):
        column = F.col(f"`{name}`")
        wanted = schema.ARTICLE_TYPES.get(name, StringType())
        if isinstance(wanted, ArrayType):
            return F.from_json(column, wanted).alias(name)
        if isinstance(wanted, StringType):
            return column.alias(name)
        # "3.0" is a count written by a tool without integer nulls.
        return column.try_cast("double").cast(wanted).alias(name)

    return raw.select(*(typed(name) for name in raw.columns))


def read_articles(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    if format == "csv":
        return read_articles_csv(spark, path)
    return spark.read.format(format).load(path)


def write_articles(
    df: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists"
) -> None:
    if format == "csv":
        export_csv(df, path, mode)
    else:
        df.write.mode(mode).format(format).save(path)


def write_topic_metadata(
    metadata: DataFrame, path: str, mode: str = "errorifexists"
) -> None:
    metadata.write.mode(mode).json(path)


def read_topic_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.TOPIC_METADATA).json(path, multiLine=True)


def metadata_keywords(metadata: DataFrame) -> DataFrame:
    """``(topic, rank, term, articles)`` of the topics in a metadata row."""
    topics = metadata.select(F.explode("topics").alias("name", "info"))
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("int")
    return topics.select(
        number.alias("topic"),
        F.posexplode("info.keywords").alias("rank", "term"),
        F.col("info.article_count").alias("articles"),
    )


def _counts_map(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: the articles of each value as a map, built on an executor."""
    counts = stats.value_counts(df, column).select(
        F.struct(F.coalesce(F.col(column).cast("string"), F.lit("None")), "articles").alias("entry")
    )
    entries = F.map_from_entries(F.collect_list("entry"))
    return counts.agg(F.coalesce(entries, F.create_map()).cast("map<string,bigint>").alias(name))


def summary_statistics(df: DataFrame, best_k: int, score: float) -> DataFrame:
    """One row: the figures of ``stats.overview`` and counts per section and topic."""
    # Three frames of one row each.
    sections = _counts_map(df, "Section", "sections")
    topics = _counts_map(df, "Topic", "topic_distribution")
    return stats.overview(df, best_k, score).join(sections).join(topics)


def export_stats_json(
    df: DataFrame, path: str, best_k: int, score: float, mode: str = "errorifexists"
) -> None:
    summary_statistics(df, best_k, score).write.mode(mode).json(path)
