import inspect
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from corpusflow.operators import features as X
from corpusflow.operators import stats, topics
from corpusflow.plans import topic_queries, update
from corpusflow.sources import exports

FIVE = ["alpha common", "beta common", "gamma common", "delta", "epsilon"]


def texts(spark, values):
    return spark.createDataFrame(
        list(enumerate(values)), "ID bigint, processed_text string"
    )


def themed(spark, per_theme=20, seed=5):
    """Articles of three themes with words of their own."""
    rng = random.Random(seed)
    rows = []
    for i in range(3 * per_theme):
        own = [f"theme{i % 3}word{j}" for j in range(12)]
        words = rng.choices(own, k=30) + rng.choices(["shared", "other"], k=3)
        rows.append((i, f"section{i % 3}", i % 3, " ".join(words)))
    return spark.createDataFrame(
        rows, "ID bigint, Section string, theme int, processed_text string"
    )


def test_vocabulary_bounds(spark):
    vocabulary = X.fit_vocabulary(texts(spark, FIVE))
    assert vocabulary.terms == ("common",)
    assert vocabulary.document_counts == (3,)
    rows = X.tfidf(texts(spark, FIVE), vocabulary).collect()
    assert {r["ID"]: r["weight"] for r in rows} == {0: 1.0, 1: 1.0, 2: 1.0}
    row = X.tfidf_stats(texts(spark, FIVE), vocabulary).first()
    assert (row["documents"], row["features"], row["nonzero"]) == (5, 1, 3)
    assert row["sparsity"] == pytest.approx(40.0)
    assert (row["mean"], row["max"]) == (pytest.approx(0.6), 1.0)


def test_vocabulary_errors(spark):
    with pytest.raises(ValueError):
        X.fit_vocabulary(texts(spark, ["only one"]))
    with pytest.raises(ValueError):
        X.fit_vocabulary(texts(spark, ["the one", "the two", "the and", "b", "c"]))
    assert X.fit_vocabulary(texts(spark, [])).terms == ()


def test_vocabulary_keeps_most_frequent(spark):
    values = ["aa aa bb cc", "aa bb cc", "aa bb bb cc", "x", "y", "z"]
    kept = X.select_vocabulary(texts(spark, values), max_features=2)
    assert [tuple(r) for r in kept.collect()] == [("aa", 3, 4), ("bb", 3, 4)]


def test_idf(spark):
    words = spark.createDataFrame([("cat",), ("dog",)], "term string")
    df = texts(spark, ["the cat", "a Cat sat", "bird"])
    got = {r["term"]: r["idf"] for r in X.idf(df, words, "processed_text").collect()}
    assert got["cat"] == pytest.approx(math.log(4 / 3) + 1)
    assert got["dog"] == pytest.approx(math.log(4 / 1) + 1)
    empty = X.idf(df.limit(0), words, "processed_text").collect()
    assert [r["idf"] for r in empty] == [0.0, 0.0]


def test_vectors_equal_rows(spark):
    df = themed(spark)
    vocabulary = X.fit_vocabulary(df)
    sparse = X.tfidf_rows(df, vocabulary).orderBy("ID").collect()
    dense = (
        X.tfidf_vectors(df, vocabulary)
        .select(vector_to_array("features").alias("v"))
        .orderBy("ID")
        .collect()
    )
    stored = X.vector_rows(X.tfidf_vectors(df, vocabulary)).orderBy("ID").collect()
    for row, again in zip(sparse, stored):
        assert dict(zip(row["indices"], row["weights"])) == pytest.approx(
            {i: w for i, w in zip(again["indices"], again["weights"]) if w}
        )
    for row, vector in zip(sparse, dense):
        expected = np.zeros(len(vocabulary.terms))
        expected[row["indices"]] = row["weights"]
        assert np.allclose(expected, vector["v"])
        assert np.linalg.norm(expected) == pytest.approx(1.0)


def test_clusters_two_pairs(spark):
    points = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0]), (3, [0.1, 0.9])]
    df = spark.createDataFrame(points, "ID bigint, p array<double>")
    df = df.select("ID", array_to_vector("p").alias("components"))
    label = {r["ID"]: r["topic"] for r in topics.cluster(df, 2).collect()}
    assert label == {0: 0, 1: 0, 2: 1, 3: 1}
    again = {r["ID"]: r["topic"] for r in topics.cluster(df, 2).collect()}
    assert again == label


def test_component_count():
    assert X.component_count(1, 5) is None
    assert X.component_count(27, 1000) == 10
    assert X.component_count(4, 1000) == 3
    assert X.component_count(2, 9) == 2


def centers(spark, weights, words, topic=0):
    return [(topic, word, weight) for word, weight in zip(words, weights)]


def test_keyword_order_and_filter(spark):
    rows = centers(spark, [0.25, 0.5, 0.75], ["rain", "snow", "hail"])
    # equal weights: the last in the alphabet first
    rows += centers(spark, [0.5, 0.5, 0.1], ["east", "west", "north"], 1)
    # the cut to n comes before the filter: "of" and "7" take two places
    rows += centers(spark, [0.9, 0.8, 0.7, 0.6], ["of", "7", "sea", "sky"], 2)
    rows += centers(
        spark, [5.0, 4.0, 3.0, 2.0, 1.0], ["policy", "2024", "said", "king", "12345"], 3
    )
    df = spark.createDataFrame(rows, "topic int, term string, weight double")

    def found(n):
        result = topics.top_keywords(df, n).orderBy("topic", "rank").collect()
        return [[r["term"] for r in result if r["topic"] == t] for t in range(5)]

    assert found(2)[:2] == [["hail", "snow"], ["west", "east"]]
    assert found(3)[2] == ["sea"]
    assert found(10)[2] == ["sea", "sky"]
    # long terms pass whatever they are; short generic, numeric, -ing ones do not
    assert found(10)[3] == ["policy", "12345"]
    assert found(10)[4] == []  # a topic without terms


def test_centers_count_zeros_and_fill_empty_topics(spark):
    vocabulary = X.Vocabulary(("a", "b"), (1, 1), 3)
    df = spark.createDataFrame(
        [(0, 0, [0], [1.0]), (1, 0, [1], [1.0]), (2, 1, [], [])],
        "ID int, topic int, indices array<int>, weights array<double>",
    )
    got = {
        (r["topic"], r["term"]): r["weight"]
        for r in topics.cluster_centers(df, vocabulary, 3).collect()
    }
    third = pytest.approx(1 / 3)
    assert got == {
        (0, "a"): 0.5, (0, "b"): 0.5, (1, "a"): 0.0, (1, "b"): 0.0,
        (2, "a"): third, (2, "b"): third,
    }


def test_labels_must_fit(spark):
    df = texts(spark, ["a", "b"])
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "ID bigint, topic int")
    with pytest.raises(ValueError):
        topics.assign_topics(df, labels)
    done = topics.assign_topics(df, labels.filter("ID < 2")).orderBy("ID").collect()
    assert [r["Topic"] for r in done] == [1, 0]
    for others in ([(8, 1), (9, 0)], [(0, 1), (0, 0)]):
        wrong = spark.createDataFrame(others, labels.schema)
        with pytest.raises(Exception, match="not one label for article"):
            topics.assign_topics(df, wrong).collect()


def test_silhouette(spark):
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(c, 1.0, (30, 3)) for c in (0, 4)] + [[[9, 9, 9]]])
    label = [0] * 30 + [1] * 30 + [2]
    rows = [(i, p.tolist(), t) for i, (p, t) in enumerate(zip(points, label))]
    df = spark.createDataFrame(rows, "ID bigint, f array<double>, topic int")
    vectors = df.select("ID", array_to_vector("f").alias("features"), "topic")
    distance = np.linalg.norm(points[:, None] - points, axis=2) ** 2
    expected = []
    for i, own in enumerate(label):
        means = [
            distance[i, [j for j, t in enumerate(label) if t == c and j != i]].mean()
            if c != own or label.count(c) > 1 else 0.0
            for c in range(3)
        ]
        if label.count(own) == 1:
            expected.append(0.0)
            continue
        a, b = means[own], min(m for c, m in enumerate(means) if c != own)
        expected.append((b - a) / max(a, b))
    assert topics.silhouette(vectors) == pytest.approx(np.mean(expected))
    assert topics.silhouette(vectors.withColumn("topic", F.lit(0))) == 0.0


def test_silhouette_has_one_rule_for_every_size(spark):
    """A sample of the rows of many copies scores as the copies' mean does."""
    rows = [(i, [float(i % 2 * 10), float(i % 3)], i % 2) for i in range(6000)]
    df = spark.createDataFrame(rows, "ID bigint, f array<double>, topic int")
    vectors = df.select("ID", array_to_vector("f").alias("features"), "topic")
    samples = topics.silhouette_samples(vectors)
    assert samples.agg(F.avg("silhouette")).first()[0] == pytest.approx(topics.silhouette(vectors))
    assert topics.silhouette(vectors) == pytest.approx(
        topics.silhouette(vectors.filter("ID < 600")), abs=0.01
    )


def test_choice_of_k():
    assert topics.choose((2, 3, 4), (0.1, 0.3, 0.3)) == 1


def test_topic_chain(spark):
    df = themed(spark)
    model = topics.fit_topics(df, (2, 3, 4), restarts=3)
    assert model.best_k == 3
    joined = df.join(model.labels, "ID")
    assert joined.select("theme", "topic").distinct().count() == 3
    assigned, metadata = topics.reprocess_topics(df, (3,))
    row = metadata.first()
    assert row["parameters"]["best_k"] == 3
    assert row["parameters"]["total_articles"] == 60
    assert {t["article_count"] for t in row["topics"].values()} == {20}
    for name, topic in row["topics"].items():
        assert len({word[:6] for word in topic["keywords"]}) == 1, name
    keywords = exports.metadata_keywords(metadata)
    assert keywords.filter("rank = 0").count() == 3
    assert topics.reprocess_topics(df.limit(10)) is None
    tables = update.chart_tables(
        assigned, model.keywords.filter("topic < 3"), 3
    )
    shares = tables["topic_distribution"].collect()
    assert sum(r["share"] for r in shares) == pytest.approx(100)
    assert {r["name"] for r in shares} == {"section0", "section1", "section2"}
    points = tables["topic_scatter"].agg(F.avg("x"), F.avg("y")).first()
    assert points[0] == pytest.approx(0, abs=1e-9)
    variance = tables["scatter_variance"].first()
    assert variance["total"] == pytest.approx(variance["pc1"] + variance["pc2"])


CHART = [(1, "A", "Sport", 0), (2, "B", "Sport", 0), (3, "C", "News", 1), (4, "D", "News", 1)]
KEYWORDS = [["goal", "match", "team"], ["election", "vote", "policy"]]


@pytest.fixture
def chart(spark):
    df = spark.createDataFrame(CHART, "ID bigint, Title string, Section string, Topic int")
    rows = [(t, r, w, 1.0) for t, ws in enumerate(KEYWORDS) for r, w in enumerate(ws)]
    return df, spark.createDataFrame(rows, "topic int, rank int, term string, weight double")


def test_chart_numbers(chart):
    df, keywords = chart
    names = {r["topic"]: r["name"] for r in stats.topic_names(df, 3).collect()}
    assert names == {0: "Sport", 1: "News", 2: "Topic 2"}
    shares = [tuple(r) for r in stats.topic_distribution(df).collect()]
    assert shares == [(0, 2, 50.0), (1, 2, 50.0)]
    matrix = stats.keyword_matrix_wide(keywords, 2).collect()
    assert [matrix[0][w] for w in ("goal", "match", "team", "vote")] == [10, 9, 8, 0]
    weights = stats.keyword_rank_weights(keywords, 2).orderBy("topic", "weight")
    assert [tuple(r) for r in weights.collect()][:2] == [(0, "match", 1), (0, "goal", 2)]
    groups = stats.group_keywords(stats.topic_names(df, 2), keywords).collect()
    assert {r["term"] for r in groups if r["name"] == "Sport"} == set(KEYWORDS[0])


def test_ties_and_groups(spark):
    df = spark.createDataFrame(
        [(1, "b", 0), (2, "a", 0), (3, "b", 1), (4, "z", 2), (5, None, 3)],
        "ID bigint, Section string, Topic int",
    )
    groups = [tuple(r) for r in stats.topic_groups(stats.topic_names(df, 4)).collect()]
    assert groups == [("b", [0, 1]), ("z", [2]), ("Topic 3", [3])]
    status = stats.store_status(df.withColumn("Published Date", F.lit("x"))).first()
    assert (status["sections"], status["earliest"]) == (4, None)


def test_checked_clustering_takes_all_restarts(spark, sf_dir, monkeypatch):
    taken, clustered = [], topics.clustered

    def counted(*args, **kwargs):
        bound = inspect.signature(clustered).bind(*args, **kwargs)
        bound.apply_defaults()
        taken.append(bound.arguments["restarts"])
        bound.arguments["restarts"] = 1
        return clustered(*bound.args, **bound.kwargs)

    monkeypatch.setattr(topics, "clustered", counted)
    topic_queries.separated_topics(spark, sf_dir)
    topic_queries.best_k(spark, sf_dir)
    assert len(taken) > 1 and set(taken) == {topics.RESTARTS}
