"""Whole jobs on the article store."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import is_blank
from corpusflow.operators import clean, stats, summarize, topics
from corpusflow.operators import features as X
from corpusflow.sources import exports, log, store
from corpusflow.sources.log import Conflict
from corpusflow.sources.scratch import cut_lineage, kept

REGENERATED = "topics found anew"


def process_batch(df: DataFrame) -> DataFrame:
    """Raw articles -> cleaned, tokenized and summarized articles."""
    return summarize.summarize_articles(clean.nlp_articles(clean.clean_articles(df)))


def append_batch(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    label: str | None = None,
    renumber: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Number, complete and write one batch; repeating a label replaces it.

    The first batch keeps IDs it already has, unless ``renumber`` is set.  ``prepare`` adds
    columns worked out row by row; rows are numbered and long texts set aside without them.
    """
    label = label or store.new_label()

    def reserve(count: int) -> int:
        return store.reserve(spark, path, label, count)

    own_ids = "ID" in new.columns and not renumber and not store.store_exists(spark, path)
    numbered = new if own_ids else store.number_new(new, reserve)
    if {"Content", "cleaned_text"} & set(numbered.columns):
        numbered = summarize.fill_missing_summaries(numbered)
    if prepare is not None:
        numbered = _summary_last(prepare(numbered))
    try:
        store.write_batch(numbered, path, label, alone=own_ids)
    except Conflict:
        if not own_ids:
            raise
        # Another writer's batch is the first one: this one is numbered after it.
        append_batch(spark, new, path, label, renumber=True, prepare=prepare)
    return label


def _summary_last(df: DataFrame) -> DataFrame:
    last = [name for name in summarize.ADDED if name in df.columns]
    return df.select(*(F.col(f"`{name}`") for name in df.columns if name not in last), *last)


def update_store(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    reprocess_topics: bool = True,
    backup: bool = False,
    k_values: Sequence[int] = topics.K_FOR_UPDATE,
) -> bool:
    """Append articles with summaries, then find topics over the whole store.

    Returns whether topics were found (a store of ten articles has none).
    Errors are raised.
    """
    if backup:
        store.snapshot(spark, path)
    append_batch(spark, kept(new, "new"), path)  # read to be numbered and by length
    return reprocess_topics and _topic_run(spark, path, k_values)


def _topic_run(
    spark: SparkSession, path: str, k_values: Sequence[int], **phase: str
) -> bool:
    """Topics of the whole store; the vocabulary is merged from the counts of its batches."""
    articles = stored_stats(spark, path).first()["total_articles"]
    if articles < topics.MIN_ARTICLES:
        return False
    texts = store.read_store(spark, path, topics=False).select("ID", "processed_text")
    vocabulary = X.vocabulary_of(store.term_counts(spark, path), articles)
    found = topics.reprocess_topics(texts, k_values, vocabulary=vocabulary, **phase)
    store.write_topics(*found, path)
    return True


def regenerate_topics(
    spark: SparkSession, path: str, k_values: Sequence[int] = topics.K_FOR_REGENERATION
) -> bool:
    """A new topic run over an existing store, with seven topics."""
    return _topic_run(spark, path, k_values, phase=REGENERATED)


def refresh_summaries(spark: SparkSession, path: str) -> bool:
    """Summarize stored articles that lack a summary; False without a store.

    Only the batches with such articles are written again, all in one job.
    """
    if not store.store_exists(spark, path):
        return False
    state = log.read(spark, path)
    rows = store.read_batches(spark, path, state.version)
    if "summary" not in rows.columns:
        rows = rows.withColumn("summary", F.lit(None).cast("string"))
    open_batches = rows.filter(is_blank(F.col("summary"))).select(store.BATCH).distinct()
    open_batches = cut_lineage(open_batches)  # one row per appended batch
    merged = F.col(store.BATCH).isin(state.base["labels"] if state.base else [])
    if not open_batches.filter(~merged).isEmpty():
        closed = rows.filter(~merged).join(open_batches, store.BATCH, "left_semi")
        store.write_batches(summarize.fill_missing_summaries(closed), path)
    if not open_batches.filter(merged).isEmpty():
        base = rows.filter(merged)
        store.rewrite_base(summarize.fill_missing_summaries(base), path, log.read(spark, path))
    return True


# --- statistics of a store, without reading its articles ---------------------


def stored_stats(spark: SparkSession, path: str) -> DataFrame:
    """``stats.store_stats`` of the whole store."""
    columns = store.column_names(spark, path)
    topics_known = "Topic" in columns or store.latest_run(spark, path) is not None
    return stats.merged_stats(
        store.read_statistics(spark, path), "summary" in columns, topics_known
    )


def stored_status(spark: SparkSession, path: str) -> DataFrame:
    """``stats.store_status`` of the whole store."""
    return stats.merged_status(store.read_statistics(spark, path))


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """``stats.store_counts`` of the whole store, with the topics of the latest run."""
    return stats.merged_counts(
        store.read_statistics(spark, path), store.read_labels(spark, path)
    )


def chart_tables(
    df: DataFrame, keywords: DataFrame, k: int, n: int = 10
) -> dict[str, DataFrame]:
    """The numbers behind each chart, by chart name.

    ``df`` holds ``ID``, ``Section``, ``Topic`` and ``processed_text``.  It and the
    keywords are written first, as most of the charts read one of them.
    """
    df, keywords = kept(df, "chart-texts"), kept(keywords, "chart-keywords")
    names = stats.topic_names(df, k)
    vocabulary = X.fit_vocabulary(df)
    vectors = X.tfidf_vectors(df, vocabulary).select("ID", "Topic", "features")
    points, variance = X.pca_projection_2d(vectors)
    return {
        "topic_distribution": _named_distribution(df, names),
        "top_keywords": stats.keyword_rank_weights(keywords, n),
        "topic_scatter": points,
        "scatter_variance": variance,
        "keywords_heatmap": stats.keyword_matrix(keywords, k, n),
        "wordclouds": stats.keyword_frequencies(keywords),
        "term_frequencies": stats.term_frequencies(df, names),
        "topic_summary": stats.topic_report(df, keywords),
        "sections": stats.section_distribution(df),
    }


def _named_distribution(df: DataFrame, names: DataFrame) -> DataFrame:
    labels = names.select(F.col("topic").alias("Topic"), "name")
    shares = stats.topic_distribution(df).join(labels, "Topic", "left")
    fallback = F.concat(F.lit("Topic "), F.col("Topic"))
    return shares.withColumn("name", F.coalesce("name", fallback))


def write_chart_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Write each table as Parquet; returns the paths by chart name."""
    paths = {name: f"{path}/{name}" for name in tables}
    for name, table in tables.items():
        table.write.parquet(paths[name])
    return paths


def export_downloads(spark: SparkSession, path: str, target: str) -> dict[str, str]:
    """CSV of all articles, and the latest run's metadata and statistics as JSON."""
    articles = store.read_store(spark, path)
    paths = {"articles": f"{target}/articles_with_topics"}
    exports.export_csv(articles, paths["articles"])
    metadata = store.read_run_metadata(spark, path)
    if metadata is not None:
        paths["metadata"] = f"{target}/topic_modeling_metadata"
        paths["statistics"] = f"{target}/summary_statistics"
        exports.write_topic_metadata(metadata, paths["metadata"])
        run = metadata.select("parameters.*").first()
        exports.export_stats_json(
            articles, paths["statistics"], run["best_k"], run["silhouette_score"]
        )
    return paths
