"""Checked queries over features, topics and topic statistics.

Most of them use given topics (``ID`` modulo ``TOPICS``), because cluster labels
cannot be reproduced in SQL; the clustering itself is in the last ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import features as X
from corpusflow.operators import stats, topics
from corpusflow.plans import oracle_parts as O
from corpusflow.sources.scratch import kept
from corpusflow.sources.tables import articles, spread, spread_articles, table

TOPICS = 4
DIGITS = 6


def _with_topic(df: DataFrame) -> DataFrame:
    return df.withColumn("Topic", F.pmod("ID", F.lit(TOPICS)).cast("int"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_topic(articles(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``texts``, worked out once for queries that read them several times."""
    return kept(texts(spark, sf_dir), "texts")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ID, Topic, processed_text)`` of all articles."""
    text = T.processed_text(T.clean_text(F.col("Content")))
    frame = spread_articles(spark, sf_dir).withColumn("processed_text", text)
    return _with_topic(frame).select("ID", "Topic", "processed_text")


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords_of(processed(spark, sf_dir))


def keywords_of(frame: DataFrame) -> DataFrame:
    vocabulary = X.fit_vocabulary(frame)
    rows = X.tfidf_rows(frame, vocabulary).withColumnRenamed("Topic", "topic")
    return topics.top_keywords(topics.cluster_centers(rows, vocabulary, TOPICS))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.topic_names(labelled(spark, sf_dir), TOPICS)


def _rounded(df: DataFrame) -> DataFrame:
    return stats.rounded(df, DIGITS)


def idf(spark, sf_dir):
    """IDF over the documents of every token of the benchmark texts."""
    tokens = F.explode(T.tokenize(F.col("text")))
    vocabulary = table(spark, sf_dir, "benchmark").select(tokens.alias("term"))
    return _rounded(X.idf(spread_articles(spark, sf_dir), vocabulary.distinct()))


def select_vocabulary(spark, sf_dir):
    return X.select_vocabulary(processed(spark, sf_dir))


def tfidf(spark, sf_dir):
    frame = processed(spark, sf_dir)
    return _rounded(X.tfidf(frame, X.fit_vocabulary(frame)))


def tfidf_stats(spark, sf_dir):
    frame = processed(spark, sf_dir)
    return _rounded(X.tfidf_stats(frame, X.fit_vocabulary(frame)))


def cluster_centers(spark, sf_dir):
    frame = processed(spark, sf_dir)
    vocabulary = X.fit_vocabulary(frame)
    rows = X.tfidf_rows(frame, vocabulary).withColumnRenamed("Topic", "topic")
    return _rounded(topics.cluster_centers(rows, vocabulary, TOPICS))


def top_keywords(spark, sf_dir):
    return _rounded(_keywords(spark, sf_dir))


def assign_topics(spark, sf_dir):
    frame = articles(spark, sf_dir)
    labels = _with_topic(frame).select("ID", F.col("Topic").alias("topic"))
    return topics.assign_topics(frame, labels).select("ID", "Title", "Topic")


def silhouette(spark, sf_dir):
    """Of the embeddings, with their labels as clusters."""
    vector = X.array_to_vector(F.col("embedding").cast("array<double>"))
    frame = table(spark, sf_dir, "embeddings").select("vec_id", vector.alias("features"), "label")
    return _rounded(topics.silhouette_samples(frame, "features", "label", "vec_id"))


def tfidf_silhouette(spark, sf_dir):
    frame = processed(spark, sf_dir)
    vectors = X.tfidf_vectors(frame, X.fit_vocabulary(frame))
    return _rounded(topics.silhouette_samples(vectors, "features", "Topic"))


def topic_distribution(spark, sf_dir):
    return _rounded(stats.topic_distribution(labelled(spark, sf_dir)))


def section_distribution(spark, sf_dir):
    return stats.section_distribution(articles(spark, sf_dir))


def top_sections_per_topic(spark, sf_dir):
    return stats.top_sections_per_topic(labelled(spark, sf_dir))


def topic_names(spark, sf_dir):
    return stats.topic_names(labelled(spark, sf_dir), TOPICS + 1)


def topic_groups(spark, sf_dir):
    """Many topics over few languages, so that names are shared."""
    frame = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ID"),
        F.col("lang").alias("Section"),
        F.pmod("doc_id", F.lit(40)).cast("int").alias("Topic"),
    )
    groups = stats.topic_groups(stats.topic_names(frame, 40))
    return groups.select("name", F.array_join("topics", ",").alias("topics"))


def group_keywords(spark, sf_dir):
    return stats.group_keywords(_names(spark, sf_dir), _keywords(spark, sf_dir))


def keyword_topic_table(spark, sf_dir):
    sizes = labelled(spark, sf_dir).groupBy(F.col("Topic").alias("topic"))
    return stats.keyword_topic_table(
        _keywords(spark, sf_dir),
        sizes.agg(F.count("*").alias("articles")),
        _names(spark, sf_dir),
    )


def keyword_rank_weights(spark, sf_dir):
    return stats.keyword_rank_weights(_keywords(spark, sf_dir), 8)


def keyword_frequencies(spark, sf_dir):
    return stats.keyword_frequencies(_keywords(spark, sf_dir))


def keyword_matrix(spark, sf_dir):
    return stats.keyword_matrix(_keywords(spark, sf_dir), TOPICS)


def term_frequencies(spark, sf_dir):
    return stats.term_frequencies(texts(spark, sf_dir), _names(spark, sf_dir))


def overview(spark, sf_dir):
    """The overview of given topics, with their silhouette on the TF-IDF vectors."""
    frame = processed(spark, sf_dir)
    vectors = X.tfidf_vectors(frame, X.fit_vocabulary(frame)).select("Topic", "features")
    score = topics.silhouette(vectors, "features", "Topic")
    return _rounded(stats.overview(articles(spark, sf_dir), TOPICS, score))


def topic_report(spark, sf_dir):
    return stats.topic_report(labelled(spark, sf_dir), _keywords(spark, sf_dir))


def topic_titles(spark, sf_dir):
    return stats.topic_titles(labelled(spark, sf_dir))


def store_counts(spark, sf_dir):
    return stats.store_counts(labelled(spark, sf_dir))


def store_stats(spark, sf_dir):
    return stats.store_stats(labelled(spark, sf_dir)).drop("last_updated")


def store_status(spark, sf_dir):
    return stats.store_status(labelled(spark, sf_dir))


# --- clustering: no SQL equivalent -----------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, X.Vocabulary]:
    frame = processed(spark, sf_dir)
    vocabulary = X.fit_vocabulary(frame)
    return X.tfidf_vectors(frame, vocabulary).select("ID", "features"), vocabulary


def kmeans_topics(spark, sf_dir):
    model = topics.fit_topics(processed(spark, sf_dir), (TOPICS,))
    return model.labels


def select_k(spark, sf_dir):
    model = topics.fit_topics(processed(spark, sf_dir))
    return _rounded(topics.score_table(spark, model.k_values, model.scores))


def topic_metadata(spark, sf_dir):
    frame = processed(spark, sf_dir)
    _, metadata = topics.reprocess_topics(frame)
    return metadata


def pca_2d(spark, sf_dir):
    vectors, _ = _vectors(spark, sf_dir)
    points, _ = X.pca_projection_2d(vectors)
    return _rounded(points)


def embedding_clusters(spark, sf_dir):
    """K-Means on the embedding vectors, one cluster per known label."""
    frame = spread(table(spark, sf_dir, "embeddings"), "vec_id")
    vectors = X.array_to_vector(F.col("embedding").cast("array<double>"))
    points = frame.select("vec_id", vectors.alias("components"), "label")
    k = frame.select(F.count_distinct("label")).first()[0]
    labels = topics.cluster(points, max(k, 2), key="vec_id")
    return labels.join(frame.select("vec_id", "label"), "vec_id")


def _two_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector of two figures of each document."""
    pair = F.array(F.length("text") / 1000.0, F.col("doc_id") % 100 / 10.0)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ID"), X.array_to_vector(pair).alias("features")
    )


def pca_squares(spark, sf_dir):
    """Squared coordinates on the main axes, whose signs are open."""
    points, _ = X.pca_projection_2d(_two_numbers(spark, sf_dir))
    return points.select(
        "ID", F.round(F.col("x") ** 2, 4).alias("x2"), F.round(F.col("y") ** 2, 4).alias("y2")
    )


def pca_variance(spark, sf_dir):
    _, variance = X.pca_projection_2d(_two_numbers(spark, sf_dir))
    return _rounded(variance)


def pca_components(spark, sf_dir):
    """Squared lengths before and after a reduction to as many dimensions."""
    reduced = X.pca(_two_numbers(spark, sf_dir), 1000, 2)
    squares = [
        F.aggregate(X.vector_to_array(c), F.lit(0.0), lambda a, x: a + x * x)
        for c in ("features", "components")
    ]
    return reduced.select(
        "ID", F.round(squares[0], 4).alias("before"), F.round(squares[1], 4).alias("after")
    )


def _separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as points far apart by language, with a small offset each."""
    languages = [r["lang"] for r in _languages(spark, sf_dir).orderBy("lang").collect()]
    hot = [F.when(F.col("lang") == name, 100.0).otherwise(0.0) for name in languages]
    offset = F.col("doc_id") % 7 / 100.0
    vector = X.array_to_vector(F.array(*hot, offset))
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("ID"), vector.alias("components"), vector.alias("features")
    )


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("lang").distinct()


def separated_topics(spark, sf_dir):
    """K-Means where the clusters are known: the languages, by size."""
    k = _languages(spark, sf_dir).count()
    return topics.cluster(_separated(spark, sf_dir), k)


def best_k(spark, sf_dir):
    """The chosen number of clusters where it is known."""
    count = _languages(spark, sf_dir).count()
    k_values = tuple(range(2, count + 2))
    _, scores = topics.select_k(_separated(spark, sf_dir), k_values)
    return spark.createDataFrame([(k_values[topics.choose(k_values, scores)],)], "best_k int")


_PROCESSED = O.joined(O.processed_list(O.clean('"Content"')))

_TFIDF = f"""{O.ARTICLES},
  proc AS MATERIALIZED (
    SELECT "ID", "ID" % {TOPICS} AS topic, {_PROCESSED} AS txt FROM articles),
  tf AS MATERIALIZED (
    SELECT "ID", topic, term, count(*) AS tf
    FROM (SELECT "ID", topic, unnest({O.tokens('txt')}) AS term FROM proc) GROUP BY ALL),
  total AS (SELECT count(*) AS n FROM documents),
  vocab AS MATERIALIZED (
    SELECT term, count(*) AS df, sum(tf) AS tf FROM tf
    WHERE term NOT IN ({O.TOPIC_STOP}) GROUP BY term
    HAVING count(*) >= 3 AND count(*) <= 0.7::DOUBLE * (SELECT n FROM total)
    ORDER BY 3 DESC, 1 LIMIT 1000),
  raw AS (
    SELECT "ID", topic, term,
           (1 + ln(tf.tf)) * (ln((1 + n)::DOUBLE / (1 + vocab.df)) + 1) AS w
    FROM tf JOIN vocab USING (term), total),
  tfidf AS MATERIALIZED (
    SELECT "ID", topic, term, w / sqrt(sum(w * w) OVER (PARTITION BY "ID")) AS weight
    FROM raw)"""

_CENTERS = f"""{_TFIDF},
  size AS (SELECT topic, count(*) AS n FROM proc GROUP BY topic),
  sums AS (SELECT topic, term, sum(weight) AS s FROM tfidf GROUP BY ALL),
  centers AS (
    SELECT size.topic AS topic, vocab.term AS term, coalesce(s / size.n, 0) AS weight
    FROM size CROSS JOIN vocab
    LEFT JOIN sums ON sums.topic = size.topic AND sums.term = vocab.term)"""

_KEYWORDS = f"""{_CENTERS},
  cut AS (
    SELECT * FROM centers QUALIFY row_number() OVER (
      PARTITION BY topic ORDER BY weight DESC, term DESC) <= 10),
  keywords AS (
    SELECT topic, term, weight,
           row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term DESC) - 1
             AS rank
    FROM cut
    WHERE (length(term) >= 3 AND NOT regexp_matches(term, '^[0-9]+$')
           AND term NOT IN ({O.GENERIC}) AND NOT ends_with(term, 'ing'))
       OR length(term) > 4)"""

_LABELLED = f"""{O.ARTICLES},
  labelled AS (SELECT *, "ID" % {TOPICS} AS "Topic" FROM articles)"""


def _names_sql(k: int = TOPICS, source: str = "labelled") -> str:
    return f"""pairs AS (
    SELECT "Topic", "Section", count(*) AS n, min("ID") AS first
    FROM {source} WHERE "Section" IS NOT NULL GROUP BY ALL),
  commonest AS (
    SELECT * FROM pairs QUALIFY row_number() OVER (
      PARTITION BY "Topic" ORDER BY n DESC, first) = 1),
  names AS (
    SELECT t.topic AS topic, coalesce("Section", 'Topic ' || t.topic) AS name
    FROM (SELECT unnest(range({k})) AS topic) t
    LEFT JOIN commonest c ON c."Topic" = t.topic)"""


_KEYWORDS_AND_NAMES = f"""{_KEYWORDS},
  labelled AS (SELECT *, "ID" % {TOPICS} AS "Topic" FROM articles), {_names_sql()}"""

_SILHOUETTES = f"""{_TFIDF},
        sums AS (SELECT topic, term, sum(weight) AS s FROM tfidf GROUP BY ALL),
        own AS (
          SELECT proc."ID" AS "ID", proc.topic AS topic, coalesce(sum(weight * weight), 0) AS q
          FROM proc LEFT JOIN tfidf USING ("ID") GROUP BY ALL),
        sizes AS (SELECT topic AS other, count(*) AS n, sum(q) AS qs FROM own GROUP BY topic),
        dots AS (
          SELECT "ID", sums.topic AS other, sum(weight * s) AS d
          FROM tfidf JOIN sums USING (term) GROUP BY ALL),
        gaps AS (
          SELECT "ID", topic, other, n, greatest(q * n + qs - 2 * coalesce(d, 0), 0) AS g
          FROM own CROSS JOIN sizes LEFT JOIN dots USING ("ID", other)),
        ab AS (
          SELECT "ID", max(CASE WHEN topic = other AND n > 1 THEN g / (n - 1) END) AS a,
                 min(CASE WHEN topic <> other THEN g / n END) AS b
          FROM gaps GROUP BY "ID"),
        scores AS (
          SELECT "ID", CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0
                            ELSE (b - a) / greatest(a, b) END AS score
          FROM ab)"""

SQL = {
    "idf": f"""WITH words AS (
          SELECT DISTINCT unnest({O.tokens('text')}) AS term FROM benchmark),
        d AS (SELECT doc_id, unnest(list_distinct({O.tokens('text')})) AS term
              FROM documents),
        c AS (SELECT term, count(*) AS df FROM d GROUP BY term)
        SELECT term, coalesce(df, 0) AS df,
               round(ln((1 + (SELECT count(*) FROM documents))::DOUBLE
                        / (1 + coalesce(df, 0))) + 1, 6) AS idf
        FROM words LEFT JOIN c USING (term)""",
    "select_vocabulary": f"WITH {_TFIDF} SELECT term, df, tf FROM vocab",
    "tfidf": f"""WITH {_TFIDF}
        SELECT "ID", term, round(weight, 6) AS weight FROM tfidf""",
    "tfidf_stats": f"""WITH {_TFIDF},
        cells AS (SELECT (SELECT count(*) FROM documents) AS documents,
                         (SELECT count(*) FROM vocab) AS features)
        SELECT documents, features, count(*) AS nonzero,
               round((1 - count(*)::DOUBLE / (documents * features)) * 100, 6)
                 AS sparsity,
               round(sum(weight) / (documents * features), 6) AS mean,
               round(max(weight), 6) AS max
        FROM tfidf, cells GROUP BY documents, features""",
    "cluster_centers": f"""WITH {_CENTERS}
        SELECT topic, term, round(weight, 6) AS weight FROM centers""",
    "top_keywords": f"""WITH {_KEYWORDS}
        SELECT topic, rank, term, round(weight, 6) AS weight FROM keywords""",
    "assign_topics": f"""WITH {_LABELLED} SELECT "ID", "Title", "Topic" FROM labelled""",
    "silhouette": """WITH flat AS (
          SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
                 generate_subscripts(embedding, 1) AS i FROM embeddings),
        sums AS (SELECT label, i, sum(x) AS s FROM flat GROUP BY ALL),
        own AS (SELECT vec_id, label, sum(x * x) AS q FROM flat GROUP BY ALL),
        sizes AS (SELECT label, count(*) AS n, sum(q) AS q FROM own GROUP BY label),
        dots AS (
          SELECT vec_id, sums.label AS other, sum(x * s) AS d
          FROM flat JOIN sums USING (i) GROUP BY ALL),
        gaps AS (
          SELECT vec_id, own.label AS label, other, n,
                 greatest(own.q * n + sizes.q - 2 * d, 0) AS g
          FROM dots JOIN own USING (vec_id) JOIN sizes ON sizes.label = other),
        ab AS (
          SELECT vec_id, max(CASE WHEN label = other AND n > 1 THEN g / (n - 1) END) AS a,
                 min(CASE WHEN label <> other THEN g / n END) AS b
          FROM gaps GROUP BY vec_id)
        SELECT vec_id, round(CASE WHEN a IS NULL OR b IS NULL THEN 0
                             ELSE (b - a) / greatest(a, b) END, 6) AS silhouette
        FROM ab""",
    "tfidf_silhouette": f"""WITH {_SILHOUETTES}
        SELECT "ID", round(score, 6) AS silhouette FROM scores""",
    "topic_distribution": f"""WITH {_LABELLED}
        SELECT "Topic", count(*) AS articles,
               round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 6)
                 AS share
        FROM labelled GROUP BY 1""",
    "section_distribution": """SELECT source AS "Section", count(*) AS articles
        FROM documents GROUP BY 1""",
    "top_sections_per_topic": f"""WITH {_LABELLED},
        c AS (SELECT "Topic", "Section", count(*) AS articles FROM labelled GROUP BY ALL)
        SELECT * FROM c QUALIFY row_number() OVER (
          PARTITION BY "Topic" ORDER BY articles DESC, "Section") <= 3""",
    "topic_names": f"""WITH {_LABELLED}, {_names_sql(TOPICS + 1)}
        SELECT topic, name FROM names""",
    "topic_groups": f"""WITH forty AS (
          SELECT doc_id AS "ID", lang AS "Section", doc_id % 40 AS "Topic"
          FROM documents), {_names_sql(40, 'forty')}
        SELECT name, string_agg(topic::VARCHAR, ',' ORDER BY topic) AS topics
        FROM names GROUP BY name""",
    "group_keywords": f"""WITH {_KEYWORDS_AND_NAMES},
        seen AS (SELECT name, term, min(topic * 100 + rank) AS place
                 FROM keywords JOIN names USING (topic) WHERE rank < 5 GROUP BY ALL),
        placed AS (SELECT name, term, row_number() OVER (
                     PARTITION BY name ORDER BY place) - 1 AS position FROM seen)
        SELECT name, position, term FROM placed WHERE position < 10""",
    "keyword_topic_table": f"""WITH {_KEYWORDS_AND_NAMES}
        SELECT name AS label, term AS keyword, n AS articles
        FROM keywords JOIN names USING (topic) JOIN size USING (topic)
        WHERE rank < 5""",
    "keyword_rank_weights": f"""WITH {_KEYWORDS}
        SELECT topic, term, least(8, count(*) OVER (PARTITION BY topic)) - rank AS weight
        FROM keywords QUALIFY rank < 8""",
    "keyword_frequencies": f"""WITH {_KEYWORDS}
        SELECT topic, term, count(*) OVER (PARTITION BY topic) - rank AS frequency
        FROM keywords""",
    "keyword_matrix": f"""WITH {_KEYWORDS}
        SELECT t.topic AS topic, w.term AS keyword,
               coalesce(10 - k.rank, 0) AS importance
        FROM (SELECT unnest(range({TOPICS})) AS topic) t
        CROSS JOIN (SELECT DISTINCT term FROM keywords) w
        LEFT JOIN keywords k ON k.topic = t.topic AND k.term = w.term""",
    "term_frequencies": f"""WITH {_TFIDF},
        labelled AS (SELECT *, "ID" % {TOPICS} AS "Topic" FROM articles), {_names_sql()},
        counts AS (SELECT name AS label, term, sum(tf) AS n, min(topic) AS topic
                   FROM tf JOIN names USING (topic) GROUP BY ALL),
        shown AS (SELECT label FROM counts GROUP BY label ORDER BY min(topic) LIMIT 6)
        SELECT label, term, n FROM counts WHERE label IN (SELECT label FROM shown)
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, term) <= 50""",
    "overview": f"""WITH {_SILHOUETTES}
        SELECT count(*) AS total_articles, {TOPICS} AS topics_discovered,
               round(count(*) / {TOPICS}.0::DOUBLE, 6) AS avg_articles_per_topic,
               round(avg(score), 6) AS silhouette_score FROM scores""",
    "topic_report": f"""WITH {_KEYWORDS},
        words AS (SELECT topic, string_agg(term, ', ' ORDER BY rank) AS keywords
                  FROM keywords WHERE rank < 5 GROUP BY topic)
        SELECT size.topic AS topic, n AS articles, keywords
        FROM size LEFT JOIN words USING (topic)""",
    "topic_titles": f"""WITH {_LABELLED}
        SELECT "Topic" AS topic, "ID", "Title", "Section" FROM labelled""",
    "store_counts": f"""WITH {_LABELLED}
        SELECT 'section' AS kind, "Section" AS name, count(*) AS articles
        FROM labelled GROUP BY ALL
        UNION ALL SELECT 'topic', "Topic"::VARCHAR, count(*) FROM labelled GROUP BY ALL""",
    "store_stats": f"""WITH {_LABELLED}
        SELECT count(*) AS total_articles, min("Published Date") AS earliest,
               max("Published Date") AS latest, false AS has_summaries,
               true AS has_topics FROM labelled""",
    "store_status": f"""WITH {_LABELLED}
        SELECT count(*) AS total_articles, count(DISTINCT "Section") AS sections,
               false AS has_summaries,
               strftime(min("Published Date"::TIMESTAMP), '%Y-%m-%d') AS earliest,
               strftime(max("Published Date"::TIMESTAMP), '%Y-%m-%d') AS latest
        FROM labelled""",
}

_NUMBERS = """numbers AS (
          SELECT doc_id AS "ID", length(text) / 1000.0::DOUBLE AS p,
                 doc_id % 100 / 10.0::DOUBLE AS q FROM documents),
        spread AS (
          SELECT avg(p) AS mp, avg(q) AS mq, var_samp(p) AS a, var_samp(q) AS c,
                 covar_samp(p, q) AS b FROM numbers),
        axes AS (
          SELECT *, 0.5::DOUBLE * atan2(2 * b, a - c) AS t,
                 sqrt(((a - c) / 2) ** 2 + b ** 2) AS r FROM spread)"""
SQL |= {
    "pca_squares": f"""WITH {_NUMBERS}
        SELECT "ID", round(((p - mp) * cos(t) + (q - mq) * sin(t)) ** 2, 4) AS x2,
               round(((q - mq) * cos(t) - (p - mp) * sin(t)) ** 2, 4) AS y2
        FROM numbers, axes""",
    "pca_variance": f"""WITH {_NUMBERS}
        SELECT round(((a + c) / 2 + r) / (a + c), 6) AS pc1,
               round(((a + c) / 2 - r) / (a + c), 6) AS pc2, 1.0::DOUBLE AS total
        FROM axes""",
    "pca_components": f"""WITH {_NUMBERS}
        SELECT "ID", round(p * p + q * q, 4) AS before, round(p * p + q * q, 4) AS after
        FROM numbers""",
    "separated_topics": """WITH sizes AS (
          SELECT lang, row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS topic
          FROM documents GROUP BY lang)
        SELECT doc_id AS "ID", topic FROM documents JOIN sizes USING (lang)""",
    "best_k": "SELECT count(DISTINCT lang) AS best_k FROM documents",
}

QUERIES = {
    function.__name__: function
    for function in (
        idf,
        select_vocabulary,
        tfidf,
        tfidf_stats,
        cluster_centers,
        top_keywords,
        assign_topics,
        silhouette,
        tfidf_silhouette,
        topic_distribution,
        section_distribution,
        top_sections_per_topic,
        topic_names,
        topic_groups,
        group_keywords,
        keyword_topic_table,
        keyword_rank_weights,
        keyword_frequencies,
        keyword_matrix,
        term_frequencies,
        overview,
        topic_report,
        topic_titles,
        store_counts,
        store_stats,
        store_status,
        kmeans_topics,
        select_k,
        topic_metadata,
        pca_2d,
        embedding_clusters,
        pca_squares,
        pca_variance,
        pca_components,
        separated_topics,
        best_k,
    )
}
