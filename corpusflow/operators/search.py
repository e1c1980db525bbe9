"""Search, filters and display projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import is_blank, preview_text, word_count

ALL = "All"
CARD_PREVIEW = 500
SEARCH_PREVIEW = 300


def search_articles(df: DataFrame, term: str | None) -> DataFrame:
    """Rows whose title or content matches ``term``, a case-insensitive pattern."""
    if not term:
        return df
    pattern = f"(?iu){term}"

    def matches(column: str):
        return F.coalesce(F.col(column).rlike(pattern), F.lit(False))

    return df.filter(matches("Title") | matches("Content"))


def filter_section(df: DataFrame, section: str = ALL) -> DataFrame:
    return df if section == ALL else df.filter(F.col("Section") == section)


def filter_topic_group(df: DataFrame, names: DataFrame, group: str = ALL) -> DataFrame:
    """Rows of all topics whose name is ``group``; ``names`` is (topic, name)."""
    if group == ALL:
        return df
    wanted = names.filter(F.col("name") == group).select(F.col("topic").alias("Topic"))
    # One row a topic: articles are not dealt out by their few topics.
    return df.join(F.broadcast(wanted), "Topic", "left_semi").select(*df.columns)


def filter_min_words(df: DataFrame, words: int = 0) -> DataFrame:
    return df.filter(F.col("word_count") >= words)


def filter_articles(
    df: DataFrame,
    query: str | None = None,
    section: str | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    limit: int = 10,
) -> DataFrame:
    """Newest ``limit`` rows that match; both dates (``yyyy-MM-dd``) are included.

    ``Published Date`` is text in sortable form, so a range is a comparison of
    texts and reaches the scan.
    """
    found = search_articles(df, query)
    date = F.col("`Published Date`")
    if section:
        found = found.filter(F.col("Section") == section)
    if from_date:
        found = found.filter(date >= from_date)
    if to_date:
        found = found.filter(date <= f"{to_date} 23:59:59")
    return found.orderBy(date.desc(), "ID").limit(limit)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ID with the columns shown in an overview."""
    shown = ["Title", "Section", "Topic", "Author", "Published Date"]
    columns = [name for name in shown if name in df.columns]
    return df.orderBy("ID").limit(n).select(*(f"`{name}`" for name in columns))


def head(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows by ID, all columns."""
    return df.orderBy("ID").limit(n)


def article_cards(df: DataFrame, limit: int = CARD_PREVIEW) -> DataFrame:
    """What a card shows: a summary (or the content) and the summary's length.

    The length is counted from the summary, else the stored one, else null.
    ``limit`` cuts both texts.
    """
    has_summary = ~is_blank(F.col("summary"))
    stored = F.when(F.col("summary_length") > 0, F.col("summary_length"))
    return df.select(
        "ID",
        "Title",
        "Section",
        "Author",
        "`Published Date`",
        "Url",
        F.when(has_summary, word_count(F.col("summary")))
        .otherwise(stored)
        .alias("summary_words"),
        F.when(F.col("summary").isNotNull(), F.lit("summary"))
        .otherwise("content")
        .alias("shown"),
        preview_text(F.coalesce("summary", "Content"), limit).alias("body"),
    )


def search_cards(df: DataFrame, names: DataFrame) -> DataFrame:
    """A search hit: the whole summary, or a short preview, and the topic's name."""
    content = preview_text(F.col("Content"), SEARCH_PREVIEW)
    # One row a topic: articles are not dealt out by their few topics.
    labels = F.broadcast(names.withColumnRenamed("topic", "Topic"))
    named = df.join(labels, "Topic", "left")
    label = F.coalesce("name", F.concat(F.lit("Topic "), F.col("Topic")))
    return named.select(
        "ID",
        "Title",
        label.alias("topic_name"),
        F.coalesce("summary", content).alias("body"),
    )


def fill_summary_length(df: DataFrame) -> DataFrame:
    """Count the words of a summary whose stored length is missing or zero."""
    if "summary" not in df.columns:
        return df
    stored = F.col("summary_length") if "summary_length" in df.columns else F.lit(0)
    unset = stored.isNull() | (stored == 0)
    counted = F.when(
        ~is_blank(F.col("summary")) & unset, word_count(F.col("summary"))
    ).otherwise(stored)
    return df.withColumn("summary_length", counted)
