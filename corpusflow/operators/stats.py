"""Statistics of articles, of the store and of topics, as DataFrames.

Counts per value are long tables, one row per value; nothing collects the rows
of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from corpusflow.functions.text import format_date, tokenize
from corpusflow.operators.windows import top_n



def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; 0.0 added so that -0.0 does not appear."""
    doubles = {
        field.name: F.round(field.name, digits) + F.lit(0.0)
        for field in df.schema.fields
        if isinstance(field.dataType, DoubleType)
    }
    return df.withColumns(doubles) if doubles else df


def text_stats(df: DataFrame) -> DataFrame:
    """Counts and lengths of cleaned text."""
    return df.agg(
        F.count("*").alias("total_articles"),
        F.count_if(F.length("cleaned_text") > 0).alias("articles_with_content"),
        F.avg("text_length").alias("average_text_length"),
        F.avg("word_count").alias("average_word_count"),
        F.min("text_length").alias("min_text_length"),
        F.max("text_length").alias("max_text_length"),
    )


def nlp_stats(df: DataFrame) -> DataFrame:
    """Average token counts and the share of tokens that were stop words."""
    before, after = F.sum("token_count"), F.sum("token_count_no_stop")
    share = F.try_divide((before - after).cast("double"), before.cast("double"))
    return df.agg(
        F.count("*").alias("total_articles"),
        F.avg("token_count").alias("average_tokens_per_article"),
        F.avg("token_count_no_stop").alias("average_tokens_no_stop"),
        F.avg("token_count_lemmatized").alias("average_tokens_lemmatized"),
        F.coalesce(share * 100, F.lit(0.0)).alias("stop_words_removed_percentage"),
    )


def summary_stats(df: DataFrame) -> DataFrame:
    """Summary lengths over non-empty summaries, ratios over all rows."""
    length = F.when(F.col("summary_length") > 0, F.col("summary_length"))
    return df.agg(
        F.count("*").alias("total_articles"),
        F.count_if(F.length("summary") > 0).alias("articles_with_summaries"),
        F.avg(length).alias("avg_summary_length"),
        F.min(length).alias("min_summary_length"),
        F.max(length).alias("max_summary_length"),
        F.avg("compression_ratio").alias("avg_compression_ratio"),
        F.min("compression_ratio").alias("min_compression_ratio"),
        F.max("compression_ratio").alias("max_compression_ratio"),
    )


# --- the store -------------------------------------------------------------


def store_stats(df: DataFrame) -> DataFrame:
    """One row: size, text-order date range, which stages have run, and when."""
    date = F.col("`Published Date`") if "Published Date" in df.columns else F.lit(None)
    return df.agg(
        F.count("*").alias("total_articles"),
        F.min(date.cast("string")).alias("earliest"),
        F.max(date.cast("string")).alias("latest"),
        F.lit("summary" in df.columns).alias("has_summaries"),
        F.lit("Topic" in df.columns).alias("has_topics"),
        F.current_timestamp().cast("string").alias("last_updated"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(column, articles)`` for the non-null values, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count("*").alias("articles")).orderBy(
        F.desc("articles"), column
    )


def store_counts(df: DataFrame) -> DataFrame:
    """``(kind, name, articles)`` for sections and topics."""
    kinds = [c for c in ("Section", "Topic") if c in df.columns]
    entries = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(c.lower()).alias("kind"), F.col(c).cast("string").alias("name")
                )
                for c in kinds
            )
        )
    )
    long = df.select(entries.alias("e")).select("e.*").filter("name IS NOT NULL")
    return long.groupBy("kind", "name").agg(F.count("*").alias("articles"))


def store_status(df: DataFrame) -> DataFrame:
    """One row: distinct sections (null is one), any summary, parsed date range."""
    day = format_date(F.col("`Published Date`"))
    summary = F.col("summary") if "summary" in df.columns else F.lit(None)
    null_section = F.max(F.col("Section").isNull().cast("int"))
    return df.agg(
        F.count("*").alias("total_articles"),
        (F.count_distinct("Section") + F.coalesce(null_section, F.lit(0))).alias(
            "sections"
        ),
        F.coalesce(F.bool_or(summary.isNotNull()), F.lit(False)).alias("has_summaries"),
        F.min(day).alias("earliest"),
        F.max(day).alias("latest"),
    )


def overview(df: DataFrame, best_k: int, score: float) -> DataFrame:
    """One row: articles, topics, articles per topic and clustering quality."""
    return df.agg(
        F.count("*").alias("total_articles"),
        F.lit(best_k).alias("topics_discovered"),
        (F.count("*") / F.lit(best_k)).alias("avg_articles_per_topic"),
        F.lit(float(score)).alias("silhouette_score"),
    )


def batch_stats(df: DataFrame, before: int, after: int) -> DataFrame:
    """One row about a processed batch and how much the store grew."""
    return df.agg(
        F.count("*").alias("articles_processed"),
        F.avg("summary_length").alias("avg_summary_length"),
        F.avg("compression_ratio").alias("avg_compression"),
        F.lit(max(after - before, 0)).cast("bigint").alias("articles_added"),
    )


# --- statistics that add up ------------------------------------------------

SECTION_PARTS = (
    "batch string, Section string, articles bigint, largest bigint, summaries bigint, "
    "earliest string, latest string, first_day string, last_day string"
)


def section_parts(df: DataFrame, batch: str = "batch") -> DataFrame:
    """Counts and bounds by batch and section: ``SECTION_PARTS``.

    Parts of a store add up to the statistics of all of it, see ``merged_*``.  Columns
    that ``df`` lacks are null.
    """

    def column(name: str, kind: str):
        present = name in df.columns
        return F.col(f"`{name}`").cast(kind) if present else F.lit(None).cast(kind)

    date = column("Published Date", "string")
    day = format_date(F.col("`Published Date`")) if "Published Date" in df.columns else date
    rows = df.select(
        F.col(batch).alias("batch"),
        column("Section", "string").alias("Section"),
        column("ID", "bigint").alias("id"),
        column("summary", "string").isNotNull().alias("summarized"),
        date.alias("date"),
        day.cast("string").alias("day"),
    )
    return rows.groupBy("batch", "Section").agg(
        F.count("*").alias("articles"),
        F.max("id").alias("largest"),
        F.count_if("summarized").alias("summaries"),
        F.min("date").alias("earliest"),
        F.max("date").alias("latest"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def merged_stats(parts: DataFrame, has_summaries: bool, has_topics: bool) -> DataFrame:
    """``store_stats`` of a store, from its ``section_parts``."""
    return parts.agg(
        F.coalesce(F.sum("articles"), F.lit(0)).alias("total_articles"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        F.lit(has_summaries).alias("has_summaries"),
        F.lit(has_topics).alias("has_topics"),
        F.current_timestamp().cast("string").alias("last_updated"),
    )


def merged_status(parts: DataFrame) -> DataFrame:
    """``store_status`` of a store, from its ``section_parts``."""
    # One row a section, so that the distinct count meets few rows.
    sections = parts.groupBy("Section").agg(
        F.sum("articles").alias("articles"),
        F.sum("summaries").alias("summaries"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    return sections.agg(
        F.coalesce(F.sum("articles"), F.lit(0)).alias("total_articles"),
        F.count("*").alias("sections"),
        (F.coalesce(F.sum("summaries"), F.lit(0)) > 0).alias("has_summaries"),
        F.min("first_day").alias("earliest"),
        F.max("last_day").alias("latest"),
    )


def merged_counts(parts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``store_counts`` of a store, from its ``section_parts`` and ``labels(ID, Topic)``."""
    found = parts.filter("Section IS NOT NULL").select(
        F.lit("section").alias("kind"), F.col("Section").alias("name"), "articles"
    )
    if labels is not None:
        topics = labels.filter("Topic IS NOT NULL").groupBy("Topic")
        found = found.unionByName(
            topics.agg(F.count("*").alias("articles")).select(
                F.lit("topic").alias("kind"), F.col("Topic").cast("string").alias("name"), "articles"
            )
        )
    return found.groupBy("kind", "name").agg(F.sum("articles").alias("articles"))


# --- sections and topics ---------------------------------------------------


def section_distribution(df: DataFrame) -> DataFrame:
    """``(Section, articles)``, most frequent first."""
    return value_counts(df, "Section")


def topic_distribution(df: DataFrame) -> DataFrame:
    """``(Topic, articles, share)`` by topic; share is a percentage of all rows."""
    counts = df.groupBy("Topic").agg(F.count("*").alias("articles"))
    # The window runs over one row per topic, not over articles.
    everything = F.sum("articles").over(Window.partitionBy(F.lit(0)))
    shared = counts.withColumn("share", F.col("articles") / everything * 100)
    return shared.filter(F.col("Topic").isNotNull()).orderBy("Topic")


def top_sections_per_topic(df: DataFrame, n: int = 3) -> DataFrame:
    """``(Topic, Section, articles)``: the ``n`` commonest sections of each topic."""
    known = df.filter(F.col("Topic").isNotNull() & F.col("Section").isNotNull())
    counts = known.groupBy("Topic", "Section").agg(F.count("*").alias("articles"))
    return top_n(counts, [F.desc("articles"), "Section"], n, ["Topic"])


def topic_names(df: DataFrame, k: int, key: str = "ID") -> DataFrame:
    """``(topic, name)`` for 0..k-1: the commonest section, or ``Topic i``.

    Equally common sections: the one with the smallest key.
    """
    known = df.filter(F.col("Section").isNotNull())
    counts = known.groupBy("Topic", "Section").agg(
        F.count("*").alias("n"), F.min(key).alias("first")
    )
    commonest = top_n(counts, [F.desc("n"), "first"], 1, ["Topic"])
    topics = df.sparkSession.range(k).select(F.col("id").cast("int").alias("topic"))
    named = topics.join(commonest, topics["topic"] == commonest["Topic"], "left")
    fallback = F.concat(F.lit("Topic "), topics["topic"])
    return named.select(topics["topic"], F.coalesce("Section", fallback).alias("name"))


def topic_groups(names: DataFrame) -> DataFrame:
    """``(name, topics)``: topics that share a name, largest groups first."""
    groups = names.groupBy("name").agg(
        F.sort_array(F.collect_list("topic")).alias("topics")
    )
    return groups.orderBy(F.desc(F.size("topics")), F.desc("name"))


def group_keywords(
    names: DataFrame, keywords: DataFrame, per_topic: int = 5, limit: int = 10
) -> DataFrame:
    """``(name, position, term)``: distinct keywords of a group in topic order."""
    first = keywords.filter(F.col("rank") < per_topic)
    seen = (
        first.join(names, "topic")
        .groupBy("name", "term")
        .agg(F.min(F.struct("topic", "rank")).alias("place"))
    )
    window = Window.partitionBy("name").orderBy("place")
    placed = seen.withColumn("position", F.row_number().over(window) - 1)
    return placed.filter(F.col("position") < limit).select("name", "position", "term")


def keyword_topic_table(
    keywords: DataFrame, sizes: DataFrame, names: DataFrame, per_topic: int = 5
) -> DataFrame:
    """``(label, keyword, articles)`` for the first keywords of each topic.

    ``sizes`` is ``(topic, articles)``.
    """
    first = keywords.filter(F.col("rank") < per_topic)
    return (
        first.join(names, "topic")
        .join(sizes, "topic", "left")
        .select(
            F.col("name").alias("label"),
            F.col("term").alias("keyword"),
            F.coalesce("articles", F.lit(0)).alias("articles"),
        )
    )


def keyword_rank_weights(keywords: DataFrame, n: int = 10) -> DataFrame:
    """``(topic, term, weight)``: the first of m shown keywords weighs m, the last 1."""
    shown = keywords.filter(F.col("rank") < n)
    size = F.count("*").over(Window.partitionBy("topic"))
    return shown.select("topic", "term", (size - F.col("rank")).alias("weight"))


def keyword_frequencies(keywords: DataFrame) -> DataFrame:
    """``(topic, term, frequency)``: number of keywords minus rank."""
    size = F.count("*").over(Window.partitionBy("topic"))
    return keywords.select("topic", "term", (size - F.col("rank")).alias("frequency"))


def keyword_matrix(keywords: DataFrame, k: int, n: int = 10) -> DataFrame:
    """``(topic, keyword, importance)`` for every topic and every shown keyword.

    Importance is ``n - rank``, or 0 where the topic does not have the keyword.
    """
    shown = keywords.filter(F.col("rank") < n)
    columns = shown.select(F.col("term").alias("keyword")).distinct()
    topics = F.sequence(F.lit(0), F.lit(k - 1))
    grid = columns.withColumn("topic", F.explode(topics))
    values = shown.select(
        "topic", F.col("term").alias("keyword"), (n - F.col("rank")).alias("value")
    )
    filled = grid.join(values, ["topic", "keyword"], "left")
    return filled.select(
        "topic", "keyword", F.coalesce("value", F.lit(0)).alias("importance")
    )


def keyword_matrix_wide(keywords: DataFrame, k: int, n: int = 10) -> DataFrame:
    """``keyword_matrix`` with one column per keyword, in alphabetical order."""
    matrix = keyword_matrix(keywords, k, n)
    return matrix.groupBy("topic").pivot("keyword").max("importance").orderBy("topic")


def term_frequencies(
    df: DataFrame,
    names: DataFrame,
    limit: int = 50,
    groups: int = 6,
    text: str = "processed_text",
) -> DataFrame:
    """``(label, term, n)``: the commonest terms of the first topic groups."""
    terms = df.select(
        F.col("Topic").alias("topic"), F.explode(tokenize(F.col(text))).alias("term")
    )
    per_topic = terms.groupBy("topic", "term").agg(F.count("*").alias("n"))
    labelled = per_topic.join(names, "topic")
    per_label = labelled.groupBy(F.col("name").alias("label"), "term").agg(
        F.sum("n").alias("n"), F.min("topic").alias("topic")
    )
    shown = (
        per_label.groupBy("label")
        .agg(F.min("topic").alias("topic"))
        .orderBy("topic")
        .limit(groups)
        .select("label")
    )
    ranked = top_n(per_label, [F.desc("n"), "term"], limit, ["label"])
    return ranked.join(shown, "label").select("label", "term", "n")


def topic_report(df: DataFrame, keywords: DataFrame, per_topic: int = 5) -> DataFrame:
    """``(topic, articles, keywords)`` with the first keywords as one text."""
    sizes = df.groupBy(F.col("Topic").alias("topic")).agg(
        F.count("*").alias("articles")
    )
    first = keywords.filter(F.col("rank") < per_topic).groupBy("topic")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
    words = first.agg(F.array_join(ordered["term"], ", ").alias("keywords"))
    return sizes.join(words, "topic", "left")


def topic_titles(df: DataFrame, key: str = "ID") -> DataFrame:
    """``(topic, key, Title, Section)``: the articles listed under each topic."""
    return df.filter(F.col("Topic").isNotNull()).select(
        F.col("Topic").alias("topic"), key, "Title", "Section"
    )
