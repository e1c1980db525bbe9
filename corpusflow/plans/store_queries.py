"""Checked queries over sources, search, store updates and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import clean, search, stats, summarize, topics, windows
from corpusflow.operators.joins import update_by_key
from corpusflow.plans import oracle_parts as O
from corpusflow.plans import topic_queries, update
from corpusflow.sources import exports, files, responses, store
from corpusflow.sources.scratch import scratch_path, without_shuffles
from corpusflow.sources.tables import articles, spread, spread_articles, table
from corpusflow.streaming.ingest import stream_ingest

TERM = "tion(s|al)? the"
PAGE_SIZE = 10
#: Compressed bytes of landed files that a stream takes at once.
MICRO_BATCH_BYTES = 32 << 20
#: The least micro-batches of the stream that stores each title once.
TITLE_BATCHES = 4
COLUMNS = ["ID", "Title", "Url", "Section", "Published Date", "Author", "Content"]


def _response_texts(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The documents as JSON responses of ``PAGE_SIZE`` articles: ``(value)``.

    In ``parts`` partitions if given; articles move once, to their response.
    """
    fields = F.struct(F.col("Author").alias("byline"), F.col("Content").alias("body"))
    article = F.struct(
        F.col("ID").cast("string").alias("id"),
        F.col("Title").alias("webTitle"),
        F.col("Url").alias("webUrl"),
        F.col("Section").alias("sectionName"),
        F.concat(
            F.replace("`Published Date`", F.lit(" "), F.lit("T")), F.lit("Z")
        ).alias("webPublicationDate"),
        fields.alias("fields"),
    )
    page = F.floor(F.col("ID") / PAGE_SIZE)
    entries = F.sort_array(F.collect_list(F.struct("ID", article.alias("article"))))
    results = F.transform(F.col("entries"), lambda e: e["article"])
    response = F.struct(
        F.lit("ok").alias("status"),
        F.size("entries").alias("total"),
        results.alias("results"),
    )
    rows = articles(spark, sf_dir).withColumn("page", page)
    if parts is not None:
        rows = rows.repartition(parts, "page")
    pages = rows.groupBy("page").agg(entries.alias("entries"))
    return pages.select(F.to_json(F.struct(response.alias("response"))).alias("value"))


def _from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages as a batch of articles without IDs."""
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("Url"),
        F.concat(F.lit("Page "), F.col("page_id")).alias("Title"),
        T.strip_html(F.col("html")).alias("Content"),
    )


def _partly_summarized(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with quality 1 have a summary, those with 0 a blank one."""
    quality = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("ID"), "quality"
    )
    summary = F.when(F.col("quality") == 1, "kept as it is").when(
        F.col("quality") == 0, "  "
    )
    return (
        df.join(quality, "ID", "left")
        .withColumn("summary", summary)
        .withColumn("summary_length", F.when(F.col("quality") == 1, 0))
        .withColumn("compression_ratio", F.lit(0.0))
        .drop("quality")
    )


def _summary_columns(df: DataFrame) -> DataFrame:
    return stats.rounded(
        df.select("ID", "summary", "summary_length", "compression_ratio")
    )


# --- sources ---------------------------------------------------------------


def flatten_response(spark, sf_dir):
    parsed = responses.parse_responses(_response_texts(spark, sf_dir))
    return responses.flatten_response(parsed)


def read_article_json(spark, sf_dir):
    path = scratch_path(spark, "responses")
    _response_texts(spark, sf_dir).write.text(path)
    return responses.flatten_response(
        responses.read_article_json(spark, path, multi_line=False)
    )


def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    frame = articles(spark, sf_dir)
    frame = frame.withColumn("tokens", T.tokenize(F.col("Content")))
    exports.write_articles(frame, path, "csv")
    read = exports.read_articles(spark, path, "csv")
    return read.withColumn("tokens", F.array_join("tokens", " "))


def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    exports.write_articles(articles(spark, sf_dir), path)
    return exports.read_articles(spark, path)


def export_stats_json(spark, sf_dir):
    path = scratch_path(spark, "statistics")
    frame = topic_queries.labelled(spark, sf_dir)
    exports.export_stats_json(frame, path, topic_queries.TOPICS, 0.0)
    counts = "sections map<string,bigint>, topic_distribution map<string,bigint>"
    read = spark.read.schema(f"total_articles bigint, {counts}").json(path)
    return read.select(
        "total_articles", F.explode("sections").alias("section", "articles")
    )


# --- search ----------------------------------------------------------------


def search_articles(spark, sf_dir):
    return search.search_articles(articles(spark, sf_dir), TERM).select("ID", "Title")


def filter_articles(spark, sf_dir):
    found = search.filter_articles(
        articles(spark, sf_dir), "the", "src7", "2024-01-05", "2024-02-20", 20
    )
    return found.select("ID", "Title", "Section", "`Published Date`")


def filter_combo(spark, sf_dir):
    """All four filters of the search page at once."""
    frame = topic_queries.labelled(spark, sf_dir)
    names = stats.topic_names(frame, topic_queries.TOPICS)
    group = names.agg(F.max("name")).first()[0]
    found = search.search_articles(frame, "ing")
    found = search.filter_topic_group(found, names, group)
    found = search.filter_section(found, group)  # the topics are named by sections
    found = search.filter_min_words(clean.clean_articles(found), 100)
    return found.select("ID", "Title", "Topic", "word_count")


def filter_section(spark, sf_dir):
    return search.filter_section(articles(spark, sf_dir), "src1").select("ID", "Section")


def filter_min_words(spark, sf_dir):
    counted = clean.clean_articles(spread_articles(spark, sf_dir))
    return search.filter_min_words(counted, 300).select("ID", "word_count")


def filter_topic_group(spark, sf_dir):
    frame = topic_queries.labelled(spark, sf_dir)
    names = stats.topic_names(frame, topic_queries.TOPICS)
    group = names.agg(F.max("name")).first()[0]
    return search.filter_topic_group(frame, names, group).select("ID", "Topic")


def preview(spark, sf_dir):
    return search.preview(topic_queries.labelled(spark, sf_dir))


def article_cards(spark, sf_dir):
    frame = _partly_summarized(articles(spark, sf_dir), spark, sf_dir)
    return search.article_cards(frame)


def search_cards(spark, sf_dir):
    frame = topic_queries.labelled(spark, sf_dir)
    names = stats.topic_names(frame, topic_queries.TOPICS)
    return search.search_cards(_partly_summarized(frame, spark, sf_dir), names)


def missing_summary(spark, sf_dir):
    frame = _partly_summarized(articles(spark, sf_dir), spark, sf_dir)
    return summarize.missing_summary(frame).select("ID", "summary")


def fill_summary_length(spark, sf_dir):
    frame = _partly_summarized(articles(spark, sf_dir), spark, sf_dir)
    return search.fill_summary_length(frame).select("ID", "summary", "summary_length")


def format_date(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "ID", T.format_date(F.col("`Published Date`")).alias("day")
    )


# --- rows ------------------------------------------------------------------


def dedup_by_title(spark, sf_dir):
    return windows.dedup_by_title(articles(spark, sf_dir)).select("ID", "Title")


def top_n(spark, sf_dir):
    """The three longest texts of each section."""
    frame = articles(spark, sf_dir).select(
        "ID", "Section", F.length("Content").alias("characters")
    )
    return windows.top_n(frame, [F.desc("characters"), "ID"], 3, ["Section"])


def assign_ids(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url", "page_id")
    return windows.assign_ids(pages, 1000, ["url", "page_id"])


def append_articles(spark, sf_dir):
    merged = store.append_articles(
        articles(spark, sf_dir), _from_pages(spark, sf_dir)
    )
    return merged.select("ID", "Title", "Url", "Section", "Content")


def update_by_id(spark, sf_dir):
    """Articles whose content is replaced by the last turn of a conversation."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("ID"), F.col("text").alias("Content"), "turn"
    )
    frame = articles(spark, sf_dir).select("ID", "Title", "Content")
    return update_by_key(frame, turns, ["Content"], "turn")


def fill_missing_summaries(spark, sf_dir):
    frame = spread_articles(spark, sf_dir).select("ID", "Content")
    frame = _partly_summarized(frame, spark, sf_dir)
    return _summary_columns(summarize.fill_missing_summaries(frame))


def batch_stats(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages"), "page_id").select(
        F.col("page_id").alias("ID"), T.strip_html(F.col("html")).alias("Content")
    )
    batch = summarize.summarize_articles(pages)
    before = articles(spark, sf_dir).count()
    return stats.rounded(stats.batch_stats(batch, before, before + pages.count()))


# --- the store -------------------------------------------------------------


def update_store(spark, sf_dir):
    """A store of the documents, updated with the web pages; topics over all of it."""
    path = scratch_path(spark, "store")
    for new, found in ((spread_articles(spark, sf_dir), False), (_from_pages(spark, sf_dir), True)):
        text = T.processed_text(T.clean_text(F.col("Content")))
        new = new.withColumn("processed_text", text)
        update.update_store(spark, new, path, reprocess_topics=found)
    stored = store.read_store(spark, path)
    labelled = F.col("Topic").between(0, max(topics.K_FOR_UPDATE) - 1).alias("labelled")
    return stored.select("ID", "Title", "summary", "summary_length", labelled)


def refresh_summaries(spark, sf_dir):
    path = scratch_path(spark, "store")
    frame = spread_articles(spark, sf_dir).select("ID", "Content")
    store.write_batch(_partly_summarized(frame, spark, sf_dir), path, "first")
    update.refresh_summaries(spark, path)
    return _summary_columns(store.read_store(spark, path))


def snapshot(spark, sf_dir):
    path = scratch_path(spark, "store")
    store.write_batch(articles(spark, sf_dir), path, "first")
    return spark.read.parquet(store.snapshot(spark, path))


def stream_articles(spark, sf_dir):
    """Responses arriving as files, ingested by a stream into a new store."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "store")
    with without_shuffles(spark):
        _response_texts(spark, sf_dir).write.option("compression", "gzip").text(landing)
    stream_ingest(
        spark,
        landing,
        path,
        scratch_path(spark, "stream"),
        multi_line=False,
        bytes_at_once=MICRO_BATCH_BYTES,
        delete_read=True,
    ).awaitTermination()
    return store.read_store(spark, path).select(
        "Title",
        "Url",
        "Author",
        "word_count",
        "token_count_no_stop",
        "summary",
        "summary_length",
    )


def stream_titles(spark, sf_dir):
    """The titles of a store that a stream of several micro-batches fills once each."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "store")
    # Packed files cannot be split: as many as a shuffle has tasks.
    parts = max(TITLE_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with without_shuffles(spark):
        packed = _response_texts(spark, sf_dir, parts).write.option("compression", "gzip")
        packed.text(landing)
    batches = max(TITLE_BATCHES, -(-files.size(spark, landing) // MICRO_BATCH_BYTES))
    stream_ingest(
        spark,
        landing,
        path,
        scratch_path(spark, "stream"),
        multi_line=False,
        unique_titles=True,
        files_at_once=-(-parts // batches),
        delete_read=True,
    ).awaitTermination()
    return store.read_store(spark, path).select("Title")


# --- topics over a store: no SQL equivalent --------------------------------


def _stored(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "store")
    frame = topic_queries.texts(spark, sf_dir).drop("Topic")
    sections = articles(spark, sf_dir).select("ID", "Title", "Section")
    store.write_batch(frame.join(sections, "ID"), path, "first")
    return path


def regenerate_topics(spark, sf_dir):
    path = _stored(spark, sf_dir)
    update.regenerate_topics(spark, path)
    return store.read_store(spark, path).select("ID", "Title", "Topic")


def stored_metadata(spark, sf_dir):
    path = _stored(spark, sf_dir)
    update.regenerate_topics(spark, path, topics.K_FOR_UPDATE)
    return exports.metadata_keywords(store.read_run_metadata(spark, path))


def chart_tables(spark, sf_dir):
    """The chart tables, written and read back: ``(chart, rows)``."""
    texts = topic_queries.processed(spark, sf_dir)
    frame = texts.join(articles(spark, sf_dir).select("ID", "Section"), "ID")
    keywords = topic_queries.keywords_of(texts)
    tables = update.chart_tables(frame, keywords, topic_queries.TOPICS)
    paths = update.write_chart_tables(tables, scratch_path(spark, "charts"))
    counts = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("chart"), F.count("*").alias("rows")
        )
        for name, path in paths.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def chart_numbers(spark, sf_dir):
    """The numbers of the chart tables, written and read back: ``(chart, label, item, value)``.

    Of the scatter, whose axes have no fixed sign, the points of each topic.
    """
    texts = topic_queries.processed(spark, sf_dir)
    frame = texts.join(articles(spark, sf_dir).select("ID", "Section"), "ID")
    keywords = topic_queries.keywords_of(texts)
    tables = update.chart_tables(frame, keywords, topic_queries.TOPICS)
    paths = update.write_chart_tables(tables, scratch_path(spark, "charts"))
    columns = {
        "topic_distribution": ("name", "Topic", "share"),
        "top_keywords": ("topic", "term", "weight"),
        "keywords_heatmap": ("topic", "keyword", "importance"),
        "wordclouds": ("topic", "term", "frequency"),
        "term_frequencies": ("label", "term", "n"),
        "topic_summary": ("topic", "keywords", "articles"),
        "sections": ("Section", "Section", "articles"),
    }
    points = spark.read.parquet(paths["topic_scatter"]).groupBy("Topic")
    result = points.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("topic_scatter").alias("chart"),
        F.col("Topic").cast("string").alias("label"),
        F.lit("points").alias("item"),
        "value",
    )
    for chart, (label, item, value) in columns.items():
        rows = spark.read.parquet(paths[chart]).select(
            F.lit(chart).alias("chart"),
            F.col(label).cast("string").alias("label"),
            F.col(item).cast("string").alias("item"),
            F.round(F.col(value).cast("double"), 6).alias("value"),
        )
        result = result.unionByName(rows)
    return result


_FILLED = f"""{O.ARTICLES},
  base AS (
    SELECT a.*, CASE quality WHEN 1 THEN 'kept as it is' WHEN 0 THEN '  ' END AS summary,
           CASE WHEN quality = 1 THEN 0 END AS summary_length
    FROM articles a LEFT JOIN labels l ON l.doc_id = a."ID")"""

_FILL = f"""WITH RECURSIVE {_FILLED},
  todo AS (SELECT * FROM base WHERE trim(coalesce(summary, '')) = ''),
  {O.summaries('todo')}
  SELECT "ID", summary, summary_length, 0.0::DOUBLE AS compression_ratio
  FROM base WHERE trim(coalesce(summary, '')) <> ''
  UNION ALL
  SELECT "ID", summary, summary_length, round(compression_ratio, 6) FROM summaries"""

_ALL = ", ".join(f'"{name}"' for name in COLUMNS)
_FLAT = f"""WITH {O.ARTICLES}
  SELECT row_number() OVER (PARTITION BY "ID" // {PAGE_SIZE} ORDER BY "ID") - 1 AS "ID",
         "Title", "Url", "Section", "Published Date",
         coalesce("Author", 'Unknown') AS "Author",
         {O.strip_html('"Content"')} AS "Content" FROM articles"""

_LABELLED = topic_queries._LABELLED
_NAMES = f"{_LABELLED}, {topic_queries._names_sql()}"
_GROUP = """"Topic" IN (SELECT topic FROM names
                        WHERE name = (SELECT max(name) FROM names))"""

_MERGED = f"""{O.ARTICLES},
  fresh AS (
    SELECT row_number() OVER (ORDER BY url, 'Page ' || page_id)
             + (SELECT max("ID") FROM articles) AS "ID",
           'Page ' || page_id AS "Title", url AS "Url",
           {O.strip_html('html')} AS "Content" FROM pages),
  merged AS (
    SELECT "ID", "Title", "Url", "Section", "Content" FROM articles
    UNION ALL SELECT "ID", "Title", "Url", NULL, "Content" FROM fresh)"""

SQL = {
    "flatten_response": _FLAT,
    "read_article_json": _FLAT,
    "csv_round_trip": f"""WITH {O.ARTICLES}
        SELECT {_ALL}, {O.joined(O.tokens('"Content"'))} AS tokens FROM articles""",
    "parquet_round_trip": f"WITH {O.ARTICLES} SELECT {_ALL} FROM articles",
    "export_stats_json": """SELECT sum(count(*)) OVER () AS total_articles,
        source AS section, count(*) AS articles FROM documents GROUP BY source""",
    "search_articles": f"""WITH {O.ARTICLES} SELECT "ID", "Title" FROM articles
        WHERE regexp_matches("Title", '{TERM}', 'i')
           OR regexp_matches("Content", '{TERM}', 'i')""",
    "filter_articles": f"""WITH {O.ARTICLES}
        SELECT "ID", "Title", "Section", "Published Date" FROM articles
        WHERE (regexp_matches("Title", 'the', 'i') OR regexp_matches("Content", 'the', 'i'))
          AND "Section" = 'src7'
          AND left("Published Date", 10) BETWEEN '2024-01-05' AND '2024-02-20'
        ORDER BY "Published Date" DESC, "ID" LIMIT 20""",
    "filter_combo": f"""WITH {_NAMES},
        hits AS (SELECT "ID", "Title", "Topic", {O.words(O.clean('"Content"'))} AS word_count
                 FROM labelled
                 WHERE (regexp_matches("Title", 'ing', 'i')
                        OR regexp_matches("Content", 'ing', 'i'))
                   AND "Section" = (SELECT max(name) FROM names) AND {_GROUP})
        SELECT * FROM hits WHERE word_count >= 100""",
    "filter_section": """SELECT doc_id AS "ID", source AS "Section" FROM documents
        WHERE source = 'src1'""",
    "filter_min_words": f"""WITH {O.ARTICLES},
        counted AS (SELECT "ID", {O.words(O.clean('"Content"'))} AS word_count FROM articles)
        SELECT * FROM counted WHERE word_count >= 300""",
    "filter_topic_group": f"""WITH {_NAMES}
        SELECT "ID", "Topic" FROM labelled WHERE {_GROUP}""",
    "preview": f"""WITH {_LABELLED}
        SELECT "Title", "Section", "Topic", "Author", "Published Date" FROM labelled
        ORDER BY "ID" LIMIT 5""",
    "article_cards": f"""WITH {_FILLED}
        SELECT "ID", "Title", "Section", "Author", "Published Date", "Url",
               CASE WHEN trim(summary) <> '' THEN {O.words('summary')}
                    WHEN summary_length > 0 THEN summary_length END AS summary_words,
               CASE WHEN summary IS NOT NULL THEN 'summary' ELSE 'content' END AS shown,
               CASE WHEN length(coalesce(summary, "Content")) > 500
                    THEN left(coalesce(summary, "Content"), 500) || '...'
                    ELSE coalesce(summary, "Content") END AS body
        FROM base""",
    "search_cards": f"""WITH {_FILLED},
        labelled AS (SELECT *, "ID" % {topic_queries.TOPICS} AS "Topic" FROM base),
        {topic_queries._names_sql()}
        SELECT "ID", "Title", name AS topic_name,
               coalesce(summary, CASE WHEN length("Content") > 300
                 THEN left("Content", 300) || '...' ELSE "Content" END) AS body
        FROM labelled JOIN names ON names.topic = labelled."Topic" """,
    "missing_summary": f"""WITH {_FILLED}
        SELECT "ID", summary FROM base WHERE trim(coalesce(summary, '')) = ''""",
    "fill_summary_length": f"""WITH {_FILLED}
        SELECT "ID", summary,
               CASE WHEN trim(coalesce(summary, '')) <> ''
                      AND coalesce(summary_length, 0) = 0 THEN {O.words('summary')}
                    ELSE summary_length END AS summary_length FROM base""",
    "format_date": f"""WITH {O.ARTICLES}
        SELECT "ID", strftime("Published Date"::TIMESTAMP, '%Y-%m-%d') AS day
        FROM articles""",
    "dedup_by_title": f"""WITH {O.ARTICLES}
        SELECT min("ID") AS "ID", "Title" FROM articles GROUP BY "Title" """,
    "top_n": """SELECT doc_id AS "ID", source AS "Section", length(text) AS characters
        FROM documents QUALIFY row_number() OVER (
          PARTITION BY source ORDER BY length(text) DESC, doc_id) <= 3""",
    "assign_ids": """SELECT 1000 + row_number() OVER (ORDER BY url, page_id) AS "ID",
        url, page_id FROM pages""",
    "append_articles": f"WITH {_MERGED} SELECT * FROM merged",
    "update_by_id": f"""WITH {O.ARTICLES},
        last AS (SELECT conv_id, arg_max(text, turn) AS text FROM conversations
                 GROUP BY conv_id)
        SELECT "ID", "Title", CASE WHEN conv_id IS NULL THEN "Content" ELSE text END
                 AS "Content"
        FROM articles LEFT JOIN last ON conv_id = "ID" """,
    "fill_missing_summaries": _FILL,
    "batch_stats": f"""WITH RECURSIVE p AS (
          SELECT page_id AS "ID", {O.strip_html('html')} AS "Content" FROM pages),
        {O.summaries('p')}
        SELECT count(*) AS articles_processed,
               round(avg(summary_length), 6) AS avg_summary_length,
               round(avg(compression_ratio), 6) AS avg_compression,
               (SELECT count(*) FROM pages) AS articles_added FROM summaries""",
    "update_store": f"""WITH RECURSIVE {_MERGED}, {O.summaries('merged')}
        SELECT "ID", "Title", summary, summary_length, true AS labelled
        FROM merged JOIN summaries USING ("ID")""",
    "refresh_summaries": _FILL,
    "chart_tables": f"""WITH {topic_queries._KEYWORDS_AND_NAMES},
        counts AS (SELECT name AS label, term, sum(tf) AS n, min(topic) AS topic
                   FROM tf JOIN names USING (topic) GROUP BY ALL),
        shown AS (SELECT label FROM counts GROUP BY label ORDER BY min(topic) LIMIT 6),
        words AS (SELECT label, least(50, count(*)) AS n FROM counts
                  WHERE label IN (SELECT label FROM shown) GROUP BY label)
        SELECT 'topic_distribution' AS chart, (SELECT count(*) FROM size) AS rows
        UNION ALL SELECT 'topic_scatter', (SELECT count(*) FROM documents)
        UNION ALL SELECT 'scatter_variance', 1
        UNION ALL SELECT 'top_keywords', (SELECT count(*) FROM keywords)
        UNION ALL SELECT 'wordclouds', (SELECT count(*) FROM keywords)
        UNION ALL SELECT 'keywords_heatmap',
          {topic_queries.TOPICS} * (SELECT count(DISTINCT term) FROM keywords)
        UNION ALL SELECT 'term_frequencies', (SELECT sum(n) FROM words)
        UNION ALL SELECT 'topic_summary', (SELECT count(*) FROM size)
        UNION ALL SELECT 'sections', (SELECT count(DISTINCT source) FROM documents)""",
    "chart_numbers": f"""WITH {topic_queries._KEYWORDS_AND_NAMES},
        counts AS (SELECT name AS label, term, sum(tf) AS n, min(topic) AS topic
                   FROM tf JOIN names USING (topic) GROUP BY ALL),
        shown AS (SELECT label FROM counts GROUP BY label ORDER BY min(topic) LIMIT 6),
        most AS (
          SELECT label, term, n FROM counts WHERE label IN (SELECT label FROM shown)
          QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, term) <= 50),
        words AS (SELECT topic, string_agg(term, ', ' ORDER BY rank) AS keywords
                  FROM keywords WHERE rank < 5 GROUP BY topic),
        grid AS (SELECT topic, term FROM (SELECT DISTINCT term FROM keywords),
                   (SELECT unnest(range({topic_queries.TOPICS})) AS topic)),
        charts AS (
          SELECT 'topic_scatter' AS chart, topic::VARCHAR AS label, 'points' AS item, n AS value
          FROM size
          UNION ALL SELECT 'topic_distribution', name, size.topic::VARCHAR,
            n * 100.0::DOUBLE / (SELECT count(*) FROM documents) FROM size JOIN names USING (topic)
          UNION ALL SELECT 'top_keywords', topic::VARCHAR, term,
            least(10, count(*) OVER (PARTITION BY topic)) - rank FROM keywords
          UNION ALL SELECT 'keywords_heatmap', topic::VARCHAR, term, coalesce(10 - rank, 0)
            FROM grid LEFT JOIN keywords USING (topic, term)
          UNION ALL SELECT 'wordclouds', topic::VARCHAR, term,
            count(*) OVER (PARTITION BY topic) - rank FROM keywords
          UNION ALL SELECT 'term_frequencies', label, term, n FROM most
          UNION ALL SELECT 'topic_summary', topic::VARCHAR, keywords, n
            FROM size LEFT JOIN words USING (topic)
          UNION ALL SELECT 'sections', source, source, count(*) FROM documents
            WHERE source IS NOT NULL GROUP BY source)
        SELECT chart, label, item, round(value::DOUBLE, 6) AS value FROM charts""",
    "snapshot": f"WITH {O.ARTICLES} SELECT {_ALL} FROM articles",
    "stream_titles": f"""WITH {O.ARTICLES} SELECT DISTINCT "Title" FROM articles""",
    "stream_articles": f"""WITH RECURSIVE {O.ARTICLES},
        flat AS (SELECT "ID", "Title", "Url", coalesce("Author", 'Unknown') AS "Author",
                        {O.strip_html('"Content"')} AS "Content" FROM articles),
        {O.summaries('flat')}
        SELECT "Title", "Url", "Author", {O.words(O.clean('"Content"'))} AS word_count,
               len({O.no_stop(O.tokens(O.clean('"Content"')))}) AS token_count_no_stop,
               summary, summary_length
        FROM flat JOIN summaries USING ("ID")""",
}

QUERIES = {
    function.__name__: function
    for function in (
        flatten_response,
        read_article_json,
        csv_round_trip,
        parquet_round_trip,
        export_stats_json,
        search_articles,
        filter_articles,
        filter_combo,
        filter_section,
        filter_min_words,
        filter_topic_group,
        preview,
        article_cards,
        search_cards,
        missing_summary,
        fill_summary_length,
        format_date,
        dedup_by_title,
        top_n,
        assign_ids,
        append_articles,
        update_by_id,
        fill_missing_summaries,
        batch_stats,
        update_store,
        refresh_summaries,
        snapshot,
        stream_articles,
        stream_titles,
        regenerate_topics,
        stored_metadata,
        chart_tables,
        chart_numbers,
    )
}
