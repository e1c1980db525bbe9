"""Checked queries over a store of several batches, versions and topic runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import features, topics
from corpusflow.plans import oracle_parts as O
from corpusflow.plans import store_queries, update
from corpusflow.sources import exports, store, updates
from corpusflow.sources.scratch import scratch_path
from corpusflow.sources.tables import articles, spread_articles

BUCKETS = 8
#: Words of a language in the texts whose topics are known.
KNOWN_WORDS = ("alpha", "bravo", "delta")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_queries._from_pages(spark, sf_dir)


def _append(new: DataFrame, path: str, label: str) -> None:
    """One batch as it is, numbered after the others, without summaries."""
    spark = new.sparkSession
    numbered = store.number_new(new, lambda n: store.reserve(spark, path, label, n))
    store.write_batch(numbered, path, label)


def _publish(spark: SparkSession, path: str, topic: Column) -> None:
    rows = store.read_store(spark, path, topics=False).select("ID", topic.alias("Topic"))
    store.write_topics(rows, spark.createDataFrame([("given",)], "phase string"), path)


def store_versions(spark, sf_dir):
    """A version from before a batch was replaced and all were merged, and the newest."""
    path = scratch_path(spark, "store")
    frame = articles(spark, sf_dir)
    store.write_batch(frame, path, "documents")
    _append(_pages(spark, sf_dir), path, "pages")
    before = store.current_version(spark, path)
    store.write_batch(frame.withColumn("Title", F.concat(F.lit("New: "), "Title")), path, "documents")
    store.consolidate(spark, path, BUCKETS)
    old = store.read_store(spark, path, version=before).withColumn("version", F.lit("old"))
    new = store.read_store(spark, path).withColumn("version", F.lit("new"))
    return old.unionByName(new).select("version", "ID", "Title", "Section")


def store_topics(spark, sf_dir):
    """Merged articles and a later batch, with the labels of the second of two runs."""
    path = scratch_path(spark, "store")
    store.write_batch(articles(spark, sf_dir), path, "documents")
    _publish(spark, path, F.pmod("ID", F.lit(4)))
    store.consolidate(spark, path, BUCKETS)
    _append(_pages(spark, sf_dir), path, "pages")
    _publish(spark, path, F.pmod("ID", F.lit(5)))
    return store.read_store(spark, path).select("ID", "Title", "Content", "Topic")


def store_statistics(spark, sf_dir):
    """Statistics of a store from those of its batches: ``(what, name, value)``."""
    path = scratch_path(spark, "store")
    summary = F.when(F.col("Author").isNotNull(), F.lit("given"))
    store.write_batch(articles(spark, sf_dir).withColumn("summary", summary), path, "documents")
    _append(_pages(spark, sf_dir), path, "pages")
    _publish(spark, path, F.pmod("ID", F.lit(4)))

    def long(df: DataFrame, what: str) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in df.columns]
        return df.select(F.lit(what).alias("what"), F.inline(F.array(*cells)))

    counts = update.stored_counts(spark, path).select(
        F.col("kind").alias("what"), "name", F.col("articles").cast("string").alias("value")
    )
    shown = long(update.stored_stats(spark, path).drop("last_updated"), "stats")
    return shown.unionByName(long(update.stored_status(spark, path), "status")).unionByName(counts)


def store_vocabulary(spark, sf_dir):
    """The vocabulary of a growing store, from term counts kept for each batch."""
    path = scratch_path(spark, "store")
    text = T.processed_text(T.clean_text(F.col("Content")))
    store.write_batch(spread_articles(spark, sf_dir).withColumn("processed_text", text), path, "a")
    store.term_counts(spark, path)
    _append(_pages(spark, sf_dir).withColumn("processed_text", text), path, "b")
    counts = store.term_counts(spark, path)
    n = update.stored_stats(spark, path).first()["total_articles"]
    most = features.MAX_DOCUMENT_SHARE * n
    return features.frequent_terms(counts, features.MIN_DOCUMENTS, most)


def store_search(spark, sf_dir):
    """A pattern in a merged store and a later batch, by the index of their files."""
    path = scratch_path(spark, "store")
    store.write_batch(articles(spark, sf_dir), path, "documents")
    store.consolidate(spark, path, BUCKETS)
    _append(_pages(spark, sf_dir), path, "pages")
    return store.search_store(spark, path, store_queries.TERM).select("ID", "Title")


def store_updates(spark, sf_dir):
    """Merged articles and a later batch, changed twice by writing the files concerned again.

    Articles get the last text of the conversation with their ID, if there is one; then
    the pages with a number that ends in 0 or 5 get a new title.
    """
    path = scratch_path(spark, "store")
    store.write_batch(articles(spark, sf_dir), path, "documents")
    store.consolidate(spark, path, BUCKETS)
    _append(_pages(spark, sf_dir), path, "pages")
    said = store_queries.table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("ID"))
    said = said.agg(F.max_by("text", "turn").alias("Content"))
    known = store.read_store(spark, path, topics=False)
    updates.update_articles(said.join(known.select("ID"), "ID", "left_semi"), path)
    pages = known.filter(F.col("Title").rlike("^Page .*[05]$"))
    updates.update_articles(pages.select("ID", F.concat(F.lit("New: "), "Title").alias("Title")), path)
    return store.read_store(spark, path).select("ID", "Title", "Content")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose words tell their language alone: one topic each."""
    words = F.concat_ws(" ", *(F.concat("lang", F.lit(word)) for word in KNOWN_WORDS))
    rows = store_queries.table(spark, sf_dir, "documents").filter("lang IS NOT NULL")
    return rows.select(
        F.col("doc_id").alias("ID"),
        F.col("source").alias("Section"),
        words.alias("processed_text"),
        F.lit("given").alias("summary"),
        F.lit(1).alias("summary_length"),
        F.lit(1.0).alias("compression_ratio"),
        F.lit("").alias("Content"),
    )


def update_topics(spark, sf_dir):
    """Labels after two updates of a store whose topics are known."""
    path = scratch_path(spark, "store")
    frame = _known(spark, sf_dir)
    update.update_store(spark, frame, path)
    update.update_store(spark, frame.drop("ID"), path)
    return store.read_store(spark, path).select("ID", "processed_text", "Topic")


def run_metadata(spark, sf_dir):
    """What is stored about a run over known topics: sizes, keywords and parameters."""
    path = scratch_path(spark, "store")
    store.write_batch(_known(spark, sf_dir), path, "documents")
    update.regenerate_topics(spark, path, topics.K_FOR_UPDATE)
    metadata = store.read_run_metadata(spark, path)
    words = exports.metadata_keywords(metadata)
    run = metadata.select(
        "phase",
        "parameters.best_k",
        F.round("parameters.silhouette_score", 6).alias("silhouette_score"),
        "parameters.total_articles",
        F.array_join(F.col("parameters.k_values_tested").cast("array<string>"), ",").alias("k_values"),
    )
    # One row meets the few of the keywords.
    return words.join(F.broadcast(run.limit(1)))


_KNOWN = f"""known AS (
    SELECT doc_id, lang,
           {" || ' ' || ".join(f"lang || '{word}'" for word in KNOWN_WORDS)} AS words
    FROM documents WHERE lang IS NOT NULL),
  ranked AS (
    SELECT lang, count(*) AS n,
           row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS topic
    FROM known GROUP BY lang)"""

SQL = {
    "store_versions": f"""WITH {store_queries._MERGED}
        SELECT 'old' AS version, "ID", "Title", "Section" FROM merged
        UNION ALL SELECT 'new', "ID", "Title", "Section" FROM merged
          WHERE "ID" > (SELECT max("ID") FROM articles)
        UNION ALL SELECT 'new', "ID", 'New: ' || "Title", "Section" FROM articles""",
    "store_topics": f"""WITH {store_queries._MERGED}
        SELECT "ID", "Title", "Content", ("ID" % 5)::INT AS "Topic" FROM merged""",
    "store_search": f"""WITH {store_queries._MERGED}
        SELECT "ID", "Title" FROM merged WHERE regexp_matches("Title", '{store_queries.TERM}', 'i')
           OR regexp_matches("Content", '{store_queries.TERM}', 'i')""",
    "store_updates": f"""WITH {store_queries._MERGED},
        said AS (SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id)
        SELECT "ID", CASE WHEN regexp_matches("Title", '^Page .*[05]$') THEN 'New: ' || "Title"
                 ELSE "Title" END AS "Title",
               CASE WHEN conv_id IS NULL THEN "Content" ELSE text END AS "Content"
        FROM merged LEFT JOIN said ON conv_id = "ID" """,
    "store_statistics": f"""WITH {O.ARTICLES},
        merged AS (
          SELECT "ID", "Section", "Published Date",
                 CASE WHEN "Author" IS NOT NULL THEN 'given' END AS summary FROM articles
          UNION ALL SELECT max_id + row_number() OVER (ORDER BY url, 'Page ' || page_id),
                 NULL, NULL, NULL
          FROM pages, (SELECT max("ID") AS max_id FROM articles)),
        figures AS (
          SELECT count(*) AS total, min("Published Date") AS a, max("Published Date") AS z,
                 count(DISTINCT "Section") + max(("Section" IS NULL)::INT) AS sections,
                 coalesce(bool_or(summary IS NOT NULL), false) AS summaries
          FROM merged)
        SELECT 'stats' AS what, unnest(['total_articles', 'earliest', 'latest', 'has_summaries',
                 'has_topics']) AS name,
               unnest([total::VARCHAR, a, z, 'true', 'true']) AS value FROM figures
        UNION ALL SELECT 'status', unnest(['total_articles', 'sections', 'has_summaries',
                 'earliest', 'latest']),
               unnest([total::VARCHAR, sections::VARCHAR, summaries::VARCHAR, left(a, 10),
                 left(z, 10)]) FROM figures
        UNION ALL SELECT 'section', "Section", count(*)::VARCHAR FROM merged
          WHERE "Section" IS NOT NULL GROUP BY "Section"
        UNION ALL SELECT 'topic', ("ID" % 4)::VARCHAR, count(*)::VARCHAR FROM merged
          GROUP BY ALL""",
    "store_vocabulary": f"""WITH {store_queries._MERGED},
        proc AS (SELECT "ID", {O.joined(O.processed_list(O.clean('"Content"')))} AS txt FROM merged),
        tf AS (SELECT "ID", term, count(*) AS tf
               FROM (SELECT "ID", unnest({O.tokens('txt')}) AS term FROM proc) GROUP BY ALL)
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf FROM tf
        WHERE term NOT IN ({O.TOPIC_STOP}) GROUP BY term
        HAVING count(*) >= 3 AND count(*) <= 0.7::DOUBLE * (SELECT count(*) FROM merged)
        ORDER BY 3 DESC, 1 LIMIT 1000""",
    "update_topics": f"""WITH {_KNOWN},
        numbered AS (
          SELECT (SELECT max(doc_id) FROM known)
                   + row_number() OVER (ORDER BY source, words) AS "ID", words, lang
          FROM known JOIN documents USING (doc_id, lang))
        SELECT k.doc_id AS "ID", words AS processed_text, topic::INT AS "Topic"
        FROM known k JOIN ranked USING (lang)
        UNION ALL SELECT "ID", words, topic::INT FROM numbered JOIN ranked USING (lang)""",
    "run_metadata": f"""WITH {_KNOWN},
        terms AS (SELECT lang AS of, lang || word AS term
                  FROM ranked, (SELECT unnest({list(KNOWN_WORDS)}) AS word)),
        placed AS (
          SELECT topic, n, term, row_number() OVER (
                   PARTITION BY topic ORDER BY lang = of DESC, term DESC) - 1 AS rank
          FROM ranked CROSS JOIN terms)
        SELECT topic::INT AS topic, rank::INT AS rank, term, n AS articles,
               '{update.REGENERATED}' AS phase, 4 AS best_k, 1.0::DOUBLE AS silhouette_score,
               (SELECT count(*) FROM known) AS total_articles, '2,3,4' AS k_values
        FROM placed WHERE rank < {topics.KEYWORDS_PER_TOPIC}""",
}

QUERIES = {
    function.__name__: function
    for function in (
        store_versions,
        store_topics,
        store_statistics,
        store_vocabulary,
        store_search,
        store_updates,
        update_topics,
        run_metadata,
    )
}
