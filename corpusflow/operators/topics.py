"""Topics: clusters of articles, their centres, keywords and quality."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow import schema
from corpusflow.functions.expr import sql_strings
from corpusflow.functions.words import GENERIC_KEYWORDS
from corpusflow.operators import features as X
from corpusflow.operators import kmeans
from corpusflow.operators.windows import top_n
from corpusflow.sources.scratch import cut_lineage

# --- fixed values: how topics are searched and described -------------------
SEED = 42
K_FOR_UPDATE = (2, 3, 4)
K_FOR_REGENERATION = (7,)
MIN_ARTICLES = 11  # fewer are not clustered
KEYWORDS_PER_TOPIC = 10
# ---------------------------------------------------------------------------

# Seeded runs of which the best one counts.
RESTARTS = 50


# --- clustering ------------------------------------------------------------


def cluster(
    df: DataFrame,
    k: int = 3,
    seed: int = SEED,
    restarts: int = RESTARTS,
    features: str = "components",
    key: str = "ID",
) -> DataFrame:
    """``(key, topic)``: K-Means labels, the best of ``restarts`` seeded runs.

    Labels are numbered by cluster size, largest first, then smallest key, so
    they do not depend on the order in which K-Means found the clusters.
    """
    labelled = clustered(df, (k,), seed, restarts, features, key)
    return labelled.select(key, F.get("topics", F.lit(0)).alias("topic"))


def clustered(
    df: DataFrame,
    k_values: Sequence[int],
    seed: int = SEED,
    restarts: int = RESTARTS,
    features: str = "components",
    key: str = "ID",
) -> DataFrame:
    """Add ``topics``, the label for each of ``k_values``; no row is joined or lost."""
    found = kmeans.fit(df, k_values, restarts, seed, features, key)
    if not found:
        return df.withColumn("topics", F.array().cast("array<int>"))
    runs = [found[k] for k in k_values]
    raw = kmeans.nearest(vector_to_array(features), runs)
    labelled = cut_lineage(df.withColumn("topics", raw))
    # One row for each k and label.
    sizes = labelled.select(key, F.posexplode("topics").alias("run", "label"))
    sizes = sizes.groupBy("run", "label").agg(F.count("*").alias("n"), F.min(key).alias("first"))
    rows = sorted(sizes.collect(), key=lambda r: (-r["n"], r["first"] is None, r["first"]))
    orders = [[r["label"] for r in rows if r["run"] == i] for i in range(len(runs))]
    numbered = [
        (F.array_position(F.lit(order), F.get("topics", F.lit(i))) - 1).cast("int")
        for i, order in enumerate(orders)
    ]
    return labelled.withColumn("topics", F.array(*numbered))


def cluster_centers(
    df: DataFrame, vocabulary: X.Vocabulary, k: int, topic: str = "topic"
) -> DataFrame:
    """``(topic, term, weight)``: mean weight per topic, for every term.

    ``df`` holds ``indices``, ``weights`` and ``topic`` per article.  Absent terms
    count as zero.  A topic without articles gets the mean of the corpus.
    """
    spark = df.sparkSession
    entries = df.select(
        F.col(topic).alias("topic"),
        F.inline(F.arrays_zip("indices", "weights")).alias("index", "w"),
    )
    # At most k * max_features rows leave this aggregation.
    sums = entries.groupBy("topic", "index").agg(F.sum("w").alias("sum"))
    sizes = df.groupBy(F.col(topic).alias("topic")).agg(F.count("*").alias("n"))
    per_topic = sums.join(sizes, "topic").select(
        "topic", "index", (F.col("sum") / F.col("n")).alias("weight")
    )
    overall = sums.groupBy("index").agg(
        (F.sum("sum") / F.lit(max(vocabulary.documents, 1))).alias("mean")
    )
    terms = spark.createDataFrame(list(enumerate(vocabulary.terms)), "index int, term string")
    grid = terms.withColumn("topic", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    filled = (
        grid.join(sizes, "topic", "left")
        .join(per_topic, ["topic", "index"], "left")
        .join(overall, "index", "left")
    )
    fallback = F.when(F.col("n").isNull(), F.col("mean"))
    weight = F.coalesce("weight", fallback, F.lit(0.0))
    return filled.select("topic", "term", weight.alias("weight"))


def is_keyword(term: Column) -> Column:
    """Long terms always; short ones if not generic, numeric or an -ing form."""
    numeric = term.rlike("^[\\p{Nd}¹²³⁰⁴-⁹₀-₉]+$")
    generic = F.array_contains(
        F.expr(f"array({sql_strings(GENERIC_KEYWORDS)})"), term
    )
    plain = ~numeric & ~generic & ~term.endswith("ing")
    return ((F.length(term) >= 3) & plain) | (F.length(term) > 4)


def top_keywords(centers: DataFrame, n: int = KEYWORDS_PER_TOPIC) -> DataFrame:
    """``(topic, rank, term, weight)``: the ``n`` heaviest terms, then filtered.

    The cut comes first, so a topic may keep fewer than ``n`` keywords.  Equal
    weights: the term that sorts last comes first.
    """
    order = [F.desc("weight"), F.desc("term")]
    heaviest = top_n(centers, order, n, ["topic"])
    kept = heaviest.filter(is_keyword(F.col("term")))
    position = Window.partitionBy("topic").orderBy(*order)
    return kept.select(
        "topic", (F.row_number().over(position) - 1).alias("rank"), "term", "weight"
    )


def assign_topics(
    df: DataFrame, labels: DataFrame, key: str = "ID", topic: str = "topic"
) -> DataFrame:
    """Add ``Topic`` from ``labels(key, topic)``.

    Every article needs exactly one label: a missing or repeated one is an error, and so
    is a label without an article.  Articles that repeat a key share its label.
    """
    # Only keys are compared, each once: the counts are combined before they meet.
    mine = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_articles"))
    given = labels.groupBy(F.col(key).alias("_of")).agg(F.count("*").alias("_labels"))
    met = mine.join(given, F.col("_key").eqNullSafe(F.col("_of")), "full")
    wrong = met.filter("_articles IS NULL OR _labels IS NULL OR _labels > 1").head()
    if wrong is not None:
        known = wrong["_key"] if wrong["_articles"] else wrong["_of"]
        counts = f"{wrong['_labels'] or 0} labels, {wrong['_articles'] or 0} articles"
        raise ValueError(f"not one label for article {known}: {counts}")
    named = labels.select(F.col(key).alias("_key"), F.col(topic).cast("int").alias("_topic"))
    base = df.drop("Topic")
    # Labels compress so well that Spark would take many of them for a small table.
    joined = base.join(named.hint("merge"), base[key].eqNullSafe(named["_key"]), "left")
    return joined.select(*(base[c] for c in base.columns), F.col("_topic").alias("Topic"))


# --- cluster quality -------------------------------------------------------


def _cluster_sums(df: DataFrame, features: str, topic: str) -> list[Row]:
    """Per label: rows, the sum of its vectors and of their squared lengths.

    One row per label leaves this aggregation, which combines before the shuffle.
    """
    metrics = Summarizer.metrics("count", "sum", "normL2").summary(F.col(features))
    sums = df.groupBy(F.col(topic).alias("topic")).agg(metrics.alias("m"))
    return sums.select("topic", "m.*").orderBy("topic").collect()


def silhouette_samples(
    df: DataFrame, features: str = "features", topic: str = "topic", key: str = "ID"
) -> DataFrame:
    """``(key, silhouette)`` of labelled ML vectors, on squared Euclidean distances.

    The mean squared distance to a cluster follows from the number, the sum and the
    squared lengths of its vectors, so a row meets one entry per label only.
    """
    sums = _cluster_sums(df, features, topic)
    shared = df.sparkSession.sparkContext.broadcast(
        (
            np.array([r["topic"] for r in sums]),
            np.array([r["count"] for r in sums], dtype=float),
            np.array([r["sum"].toArray() for r in sums]),
            np.array([(r["normL2"].toArray() ** 2).sum() for r in sums]),
        )
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, sizes, totals, squares = shared.value
        for batch in batches:
            if batch.empty:
                continue
            own = np.array(batch["vector"].tolist(), dtype=float).reshape(len(batch), -1)
            length = (own**2).sum(axis=1)[:, None]
            gaps = np.maximum(length * sizes + squares - 2 * own @ totals.T, 0.0)
            mine = np.searchsorted(labels, batch["topic"].to_numpy())
            row = np.arange(len(batch))
            inside = gaps[row, mine] / np.maximum(sizes[mine] - 1, 1)
            means = gaps / sizes
            means[row, mine] = np.inf
            nearest = means.min(axis=1)
            widest = np.maximum(np.maximum(inside, nearest), 1e-300)
            alone = (sizes[mine] == 1) | (len(labels) == 1)
            score = np.where(alone, 0.0, (nearest - inside) / widest)
            yield pd.DataFrame({key: batch[key], "silhouette": score})

    table = df.select(
        key, vector_to_array(features).alias("vector"), F.col(topic).alias("topic")
    )
    key_type = table.schema[key].dataType.simpleString()
    return table.mapInPandas(measure, f"{key} {key_type}, silhouette double")


def silhouette(
    df: DataFrame, features: str = "features", topic: str = "topic", key: str = "ID"
) -> float:
    """Mean of ``silhouette_samples``; 0.0 with fewer than two labels."""
    if df.select(topic).distinct().limit(2).count() < 2:
        return 0.0
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=topic, distanceMeasure="squaredEuclidean"
    )
    return float(evaluator.evaluate(df))


# --- choice of k and the whole chain ---------------------------------------


@dataclass(frozen=True)
class TopicModel:
    """Labels, keywords and scores of the chosen clustering."""

    labels: DataFrame  # (ID, topic)
    keywords: DataFrame  # (topic, rank, term, weight)
    vocabulary: X.Vocabulary
    best_k: int
    score: float
    k_values: tuple[int, ...]
    scores: tuple[float, ...]


def choose(k_values: Sequence[int], scores: Sequence[float]) -> int:
    """Position of the best score; the first one on ties."""
    return max(range(len(k_values)), key=lambda i: (scores[i], -i))


def select_k(
    df: DataFrame,
    k_values: Sequence[int] = K_FOR_UPDATE,
    seed: int = SEED,
    restarts: int = RESTARTS,
    key: str = "ID",
) -> tuple[dict[int, DataFrame], list[float]]:
    """Labels and silhouette for each k.

    ``df`` holds ``features`` (scored) and ``components`` (clustered).  All k are
    clustered in the same passes, and rows are scored where they were labelled.
    """
    labelled = clustered(df, k_values, seed, restarts, key=key)
    labels, scores = {}, []
    for i, k in enumerate(k_values):
        topic = F.get("topics", F.lit(i)).alias("topic")
        labels[k] = labelled.select(key, topic)
        scores.append(silhouette(labelled.select("features", topic)))
    return labels, scores


def score_table(
    spark: SparkSession, k_values: Sequence[int], scores: Sequence[float]
) -> DataFrame:
    return spark.createDataFrame(
        [(k, float(s)) for k, s in zip(k_values, scores)], "k int, score double"
    )


def fit_topics(
    df: DataFrame,
    k_values: Sequence[int] = K_FOR_UPDATE,
    text: str = "processed_text",
    seed: int = SEED,
    restarts: int = RESTARTS,
    key: str = "ID",
    vocabulary: X.Vocabulary | None = None,
) -> TopicModel:
    """TF-IDF, PCA, K-Means for each k, keywords of the best one.

    A ``vocabulary`` that is known already spares counting the terms of all texts.
    """
    texts = df.select(key, F.coalesce(text, F.lit("")).alias(text))
    vocabulary = vocabulary or X.fit_vocabulary(texts, text)
    vectors = X.tfidf_vectors(texts, vocabulary, text).select(key, "features")
    # K-Means reads its input dozens of times: keep the small projection and
    # the sparse weights in reliable storage.
    vectors = cut_lineage(vectors)  # also read for the centres, not the texts
    reduced = X.pca(vectors, vocabulary.documents, len(vocabulary.terms))
    reduced = cut_lineage(reduced)
    labels, scores = select_k(reduced, k_values, seed, restarts, key)
    best = choose(k_values, scores)
    chosen = labels[k_values[best]]
    weights = X.vector_rows(vectors).select(key, "indices", "weights")
    centers = cluster_centers(weights.join(chosen, key), vocabulary, k_values[best])
    return TopicModel(
        labels=chosen,
        keywords=top_keywords(centers),
        vocabulary=vocabulary,
        best_k=k_values[best],
        score=scores[best],
        k_values=tuple(k_values),
        scores=tuple(scores),
    )


def topic_metadata(
    articles: DataFrame,
    model: TopicModel,
    phase: str,
    timestamp: str | None = None,
    topic: str = "Topic",
) -> DataFrame:
    """One nested row: parameters, and keywords and size of each topic."""
    spark = articles.sparkSession
    sizes = {row[0]: row[1] for row in articles.groupBy(topic).count().collect()}
    keywords: dict[int, list[str]] = {i: [] for i in range(model.best_k)}
    for row in model.keywords.orderBy("topic", "rank").collect():
        keywords[row["topic"]].append(row["term"])
    topics = {
        f"topic_{i}": (words[:KEYWORDS_PER_TOPIC], sizes.get(i, 0))
        for i, words in keywords.items()
    }
    parameters = (
        model.best_k,
        float(model.score),
        sum(sizes.values()),
        len(model.vocabulary.terms),
        list(model.k_values),
        [float(s) for s in model.scores],
    )
    stamp = timestamp or datetime.datetime.now().isoformat()
    return spark.createDataFrame(
        [(stamp, phase, parameters, topics)], schema.TOPIC_METADATA
    )


def reprocess_topics(
    df: DataFrame,
    k_values: Sequence[int] = K_FOR_UPDATE,
    phase: str = "store update",
    key: str = "ID",
    vocabulary: X.Vocabulary | None = None,
) -> tuple[DataFrame, DataFrame] | None:
    """Articles with new topics, and the run's metadata; None for few articles."""
    if df.limit(MIN_ARTICLES).count() < MIN_ARTICLES:
        return None
    model = fit_topics(df, k_values, key=key, vocabulary=vocabulary)
    assigned = assign_topics(df, model.labels, key)
    return assigned, topic_metadata(assigned, model, phase)
