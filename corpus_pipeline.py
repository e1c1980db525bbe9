"""The corpus pipeline: documents in, token digests of clean, unique documents out.

Each stage takes ``(spark, docs, sf_dir)`` and calls one operator on all rows that its
predecessor kept. Between stages the rows are written as Parquet and read again, so a
lost executor costs a part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import common, decontaminate, line_dedup, quality, queries, simhash
from corpusflow.sources.scratch import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy; the others go."""
    return quality.kept_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs and long lines are taken out of the texts."""
    slim = line_dedup.drop_repeated_lines(docs)
    return slim.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Rows that repeat an id are one document and stay together; rows without an id stay
    if one of them has no document with an id in its group.
    """
    groups = simhash.near_duplicates(docs).filter("doc_id <=> component_id")
    stays = groups.select(F.col("doc_id").alias("stays"))
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays["stays"]), "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    (matches,) = common.fresh(docs, "_matches")
    items = queries.table(spark, sf_dir, "benchmark")
    found = decontaminate.with_matches(docs, items, matches_col=matches)
    return found.filter(F.size(matches) == 0).select(*docs.columns)


def byte_bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return queries.byte_bpe_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe_encoding", byte_bpe_encoding),
]

#: Merging byte pairs by rank has no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    root = scratch_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
