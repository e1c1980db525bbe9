"""TF-IDF features and their projections.

A vocabulary has at most ``max_features`` terms, so it lives on the driver and
travels with the plan.  Weights are computed inside each article's row
(``indices`` and ``weights`` arrays); the long ``(ID, term, weight)`` form is one
``explode`` away.  No step shuffles (article, term) rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (
    PCA,
    CountVectorizerModel,
    Normalizer,
    PCAModel,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.expr import let, sql_strings, total
from corpusflow.functions.text import tokenize
from corpusflow.functions.words import TOPIC_STOP_WORDS
from corpusflow.sources.scratch import cut_lineage

# --- fixed values: which terms become features -----------------------------
MIN_DOCUMENTS = 3
MAX_DOCUMENT_SHARE = 0.7
MAX_FEATURES = 1000
MAX_COMPONENTS = 10
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Feature terms in alphabetical order with their document counts."""

    terms: tuple[str, ...]
    document_counts: tuple[int, ...]
    documents: int

    @property
    def idf(self) -> list[float]:
        return [smooth_idf(self.documents, n) for n in self.document_counts]


def smooth_idf(documents: int, containing: int) -> float:
    return math.log((1 + documents) / (1 + containing)) + 1.0


def term_document_counts(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, term, df, tf)`` over the whole corpus, in one pass and one shuffle.

    Every occurrence is an entry that counts for ``tf``, every distinct term of
    an article one that counts for ``df``; entries are combined before the
    shuffle, so a term found everywhere costs no more than a rare one.  Counts of
    parts (``by``) add up to those of the whole.
    """
    tokens = df.select(*by, tokenize(F.col(text)).alias("tokens"))

    def entries(terms, occurrences: int, documents: int):
        return F.transform(
            terms,
            lambda t: F.struct(
                t.alias("term"),
                F.lit(occurrences).alias("tf"),
                F.lit(documents).alias("df"),
            ),
        )

    both = F.concat(
        entries(F.col("tokens"), 1, 0), entries(F.array_distinct("tokens"), 0, 1)
    )
    return (
        tokens.select(*by, F.inline(both))
        .groupBy(*by, "term")
        .agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    )


def idf(df: DataFrame, vocabulary: DataFrame, text: str = "Content") -> DataFrame:
    """``(term, df, idf)`` for each ``term`` of ``vocabulary``; unknown terms have df 0."""
    documents = df.count()
    if documents == 0:
        return vocabulary.select(
            "term", F.lit(0).cast("bigint").alias("df"), F.lit(0.0).alias("idf")
        )
    tokens = F.array_distinct(tokenize(F.col(text)))
    # Counted before the join: a very frequent term then is one row per task.
    counts = df.select(F.explode(tokens).alias("term")).groupBy("term")
    found = vocabulary.join(counts.agg(F.count("*").alias("df")), "term", "left")
    found = found.select("term", F.coalesce("df", F.lit(0)).alias("df"))
    value = F.log(F.lit(float(1 + documents)) / (F.col("df") + 1)) + 1.0
    return found.withColumn("idf", value)


def select_vocabulary(
    df: DataFrame,
    text: str = "processed_text",
    min_df: int = MIN_DOCUMENTS,
    max_df: float = MAX_DOCUMENT_SHARE,
    max_features: int = MAX_FEATURES,
    stop: Sequence[str] = TOPIC_STOP_WORDS,
) -> DataFrame:
    """``(term, df, tf)`` of the feature terms: most frequent first, ties by term."""
    documents = df.count()
    if max_df * documents < min_df:
        raise ValueError(f"{documents} documents are too few for min_df={min_df}")
    counts = term_document_counts(df, text)
    return frequent_terms(counts, min_df, max_df * documents, max_features, stop)


def frequent_terms(
    counts: DataFrame,
    min_df: int,
    most_documents: float,
    max_features: int = MAX_FEATURES,
    stop: Sequence[str] = TOPIC_STOP_WORDS,
) -> DataFrame:
    """The feature terms among ``counts(term, df, tf)``: most frequent first, ties by term."""
    if stop:
        counts = counts.filter(F.expr(f"term not in ({sql_strings(stop)})"))
    kept = counts.filter(F.col("df").between(F.lit(min_df), F.lit(most_documents)))
    return kept.orderBy(F.desc("tf"), "term").limit(max_features)


def fit_vocabulary(
    df: DataFrame,
    text: str = "processed_text",
    min_df: int = MIN_DOCUMENTS,
    max_df: float = MAX_DOCUMENT_SHARE,
    max_features: int = MAX_FEATURES,
    stop: Sequence[str] = TOPIC_STOP_WORDS,
) -> Vocabulary:
    """The feature terms of ``select_vocabulary`` (at most ``max_features`` rows)."""
    counts = term_document_counts(df, text)
    return vocabulary_of(counts, df.count(), min_df, max_df, max_features, stop)


def vocabulary_of(
    counts: DataFrame,
    documents: int,
    min_df: int = MIN_DOCUMENTS,
    max_df: float = MAX_DOCUMENT_SHARE,
    max_features: int = MAX_FEATURES,
    stop: Sequence[str] = TOPIC_STOP_WORDS,
) -> Vocabulary:
    """The feature terms of a corpus whose ``counts(term, df, tf)`` are known."""
    if documents == 0:
        return Vocabulary((), (), 0)
    if max_df * documents < min_df:
        raise ValueError(f"{documents} documents are too few for min_df={min_df}")
    terms = frequent_terms(counts, min_df, max_df * documents, max_features, stop)
    rows = sorted((row["term"], row["df"]) for row in terms.select("term", "df").collect())
    if not rows:
        raise ValueError("no term is frequent enough and not too frequent")
    return Vocabulary(
        tuple(term for term, _ in rows), tuple(n for _, n in rows), documents
    )


def _with_counts(df: DataFrame, vocabulary: Vocabulary, text: str) -> DataFrame:
    """Add ``_counts``, the term frequencies as an ML vector, row by row."""
    counter = CountVectorizerModel.from_vocabulary(
        list(vocabulary.terms), inputCol="_tokens", outputCol="_counts"
    )
    return counter.transform(df.withColumn("_tokens", tokenize(F.col(text)))).drop(
        "_tokens"
    )


def _idf_array(vocabulary: Vocabulary) -> Column:
    values = ", ".join(f"{value!r}D" for value in vocabulary.idf)
    return F.expr(f"cast(array({values}) as array<double>)")


def tfidf_rows(
    df: DataFrame, vocabulary: Vocabulary, text: str = "processed_text"
) -> DataFrame:
    """Add ``indices`` and ``weights``: ``(1 + ln tf) * idf``, rows of length one.

    An article without any feature term has empty arrays.
    """
    idf_values = _idf_array(vocabulary)
    counts = F.unwrap_udt("_counts")

    def weigh(c):
        raw = F.zip_with(
            c["values"],
            c["indices"],
            lambda tf, i: (F.log(tf) + 1.0) * F.get(idf_values, i),
        )

        def normalize(w):
            squares = total(F.transform(w, lambda x: x * x))
            return let(F.sqrt(squares), lambda n: F.transform(w, lambda x: x / n))

        return F.struct(
            c["indices"].alias("indices"), let(raw, normalize).alias("weights")
        )

    weighed = _with_counts(df, vocabulary, text).withColumn("_w", let(counts, weigh))
    return weighed.withColumns(
        {"indices": F.col("_w.indices"), "weights": F.col("_w.weights")}
    ).drop("_w", "_counts")


def tfidf(
    df: DataFrame,
    vocabulary: Vocabulary,
    text: str = "processed_text",
    key: str = "ID",
) -> DataFrame:
    """The non-zero weights in long form: ``(key, term, weight)``."""
    rows = tfidf_rows(df, vocabulary, text)
    entries = rows.select(
        key, F.inline(F.arrays_zip("indices", "weights")).alias("index", "weight")
    )
    terms = F.expr(f"array({sql_strings(vocabulary.terms)})")
    return entries.select(key, F.get(terms, F.col("index")).alias("term"), "weight")


def tfidf_stats(
    df: DataFrame, vocabulary: Vocabulary, text: str = "processed_text"
) -> DataFrame:
    """Shape, fill and weights of the whole documents x terms matrix."""
    features = len(vocabulary.terms)
    rows = tfidf_rows(df, vocabulary, text).select(
        F.size("indices").alias("n"),
        total(F.col("weights")).alias("sum"),
        F.array_max("weights").alias("max"),
    )
    cells = F.count("*").cast("double") * features
    return rows.agg(
        F.count("*").alias("documents"),
        F.lit(features).cast("bigint").alias("features"),
        F.sum("n").alias("nonzero"),
        ((1 - F.try_divide(F.sum("n").cast("double"), cells)) * 100).alias("sparsity"),
        F.try_divide(F.sum("sum"), cells).alias("mean"),
        F.coalesce(F.max("max"), F.lit(0.0)).alias("max"),
    )


def tfidf_vectors(
    df: DataFrame, vocabulary: Vocabulary, text: str = "processed_text"
) -> DataFrame:
    """Add ``features``, the weights of ``tfidf_rows`` as a sparse ML vector."""
    idf_values = _idf_array(vocabulary)
    raw = F.transform(
        vector_to_array("_counts"),
        lambda tf, i: F.when(
            tf > 0, (F.log(tf) + 1.0) * F.get(idf_values, i)
        ).otherwise(0.0),
    )
    dense = _with_counts(df, vocabulary, text).withColumn("_raw", array_to_vector(raw))
    scaled = Normalizer(inputCol="_raw", outputCol="_unit", p=2.0).transform(dense)
    # The assembler stores a vector the shorter way, which is sparse here.
    packed = VectorAssembler(inputCols=["_unit"], outputCol="features")
    return packed.transform(scaled).drop("_counts", "_raw", "_unit")


def vector_rows(df: DataFrame, features: str = "features") -> DataFrame:
    """``indices`` and ``weights`` of stored vectors, as in ``tfidf_rows``.

    A vector with few zeros is stored dense and has no indices of its own.
    """
    vector = F.unwrap_udt(features)
    last = F.size(vector["values"]) - 1
    indices = F.coalesce(vector["indices"], F.sequence(F.lit(0), last))
    return df.withColumns({"indices": indices, "weights": vector["values"]})


def component_count(documents: int, features: int) -> int | None:
    """Number of principal components used for clustering; None: do not reduce."""
    if documents <= 1 or features <= 1:
        return None
    return max(2, min(MAX_COMPONENTS, documents - 1, features - 1))


def fit_pca(df: DataFrame, k: int, features: str = "features") -> PCAModel:
    return PCA(k=k, inputCol=features, outputCol="components").fit(df)


def pca(df: DataFrame, documents: int, features: int) -> DataFrame:
    """Add ``components``, the reduced ``features`` (the features if too few)."""
    k = component_count(documents, features)
    if k is None:
        return df.withColumn("components", F.col("features"))
    return fit_pca(df, k).transform(df)


def pca_projection_2d(df: DataFrame, key: str = "ID") -> tuple[DataFrame, DataFrame]:
    """Centred 2-D map and the variance it explains.

    Returns ``(key, x, y)`` (with ``Topic`` if present) and one row
    ``(pc1, pc2, total)``.  The ML projection is not centred, so the column means
    are subtracted.  The features are read several times and so written first.
    """
    df = cut_lineage(df)
    model = fit_pca(df, 2)
    points = model.transform(df).withColumn("_p", vector_to_array("components"))
    x, y = F.get("_p", F.lit(0)), F.get("_p", F.lit(1))
    means = points.agg(F.avg(x).alias("x"), F.avg(y).alias("y")).first()
    extra = ["Topic"] if "Topic" in df.columns else []
    centred = points.select(
        key,
        (x - F.lit(means["x"])).alias("x"),
        (y - F.lit(means["y"])).alias("y"),
        *extra,
    )
    share = [float(v) for v in model.explainedVariance.toArray()]
    variance = df.sparkSession.createDataFrame(
        [(share[0], share[1], share[0] + share[1])],
        "pc1 double, pc2 double, total double",
    )
    return centred, variance
