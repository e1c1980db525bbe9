"""Checked queries over text: cleaning, tokens, sentences, graphs, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import sentences as S
from corpusflow.functions import text as T
from corpusflow.operators import clean, graph, stats, summarize
from corpusflow.plans import oracle_parts as O
from corpusflow.sources.tables import articles, spread, spread_articles, table

DIGITS = 6


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")


def _joined(tokens) -> Column:
    return F.array_join(tokens, " ")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_articles(spread_articles(spark, sf_dir))


def strip_html_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id", T.strip_html(F.col("html")).alias("body")
    )


def clean_text_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id", T.clean_text(F.col("html")).alias("cleaned_text")
    )


def clean_articles(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "ID", "cleaned_text", "text_length", "word_count"
    )


def tokenize(spark, sf_dir):
    tokens = T.tokenize(F.col("Content"))
    return (
        spread_articles(spark, sf_dir)
        .select("ID", tokens.alias("tokens"))
        .select("ID", _joined("tokens").alias("tokens"), F.size("tokens").alias("n"))
    )


def remove_stop_words(spark, sf_dir):
    kept = T.remove_stop_words(T.tokenize(F.col("Content")))
    return spread_articles(spark, sf_dir).select("ID", _joined(kept).alias("tokens"))


def stem(spark, sf_dir):
    stems = T.stem(T.tokenize(F.col("Content")))
    return spread_articles(spark, sf_dir).select("ID", _joined(stems).alias("tokens"))


def processed_text(spark, sf_dir):
    return spread_articles(spark, sf_dir).select(
        "ID", T.processed_text(F.col("Content")).alias("processed_text")
    )


def nlp_articles(spark, sf_dir):
    return clean.nlp_articles(cleaned(spark, sf_dir)).select(
        "ID",
        _joined("tokens").alias("tokens"),
        _joined("tokens_no_stop").alias("tokens_no_stop"),
        _joined("tokens_lemmatized").alias("tokens_lemmatized"),
        "processed_text",
        "token_count",
        "token_count_no_stop",
        "token_count_lemmatized",
    )


def term_counts(spark, sf_dir):
    tokens = T.tokenize(F.col("Content"))
    frame = spread_articles(spark, sf_dir).select("ID", tokens.alias("tokens"))
    return clean.term_counts(frame)


def preview_text(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "ID",
        T.preview_text(F.col("Content"), 500).alias("long_preview"),
        T.preview_text(F.col("Content"), 300).alias("short_preview"),
    )


def split_sentences(spark, sf_dir):
    return graph.sentences(spread_articles(spark, sf_dir))


def sentence_quality(spark, sf_dir):
    scores = S.score_sentences(S.split_sentences(F.col("Content")))
    return (
        spread_articles(spark, sf_dir)
        .select("ID", F.posexplode(scores).alias("idx", "s"))
        .select(
            "ID",
            "idx",
            F.col("s.pos").alias("pos"),
            F.round(-F.col("s.rank_key"), DIGITS).alias("score"),
            F.col("s.sentence").alias("sentence"),
        )
    )


def sentence_similarity(spark, sf_dir):
    """Similarity of each document's text to its title."""
    score = S.sentence_similarity(F.col("Title"), F.col("Content"))
    return spread_articles(spark, sf_dir).select(
        "ID", F.round(score, DIGITS).alias("similarity")
    )


def sentence_edges(spark, sf_dir):
    edges = graph.sentence_edges(spread_articles(spark, sf_dir))
    return edges.withColumn("weight", F.round("weight", DIGITS))


def pagerank_by_doc(spark, sf_dir):
    ranks = graph.pagerank_by_doc(spread_articles(spark, sf_dir))
    return ranks.withColumn("rank", F.round("rank", DIGITS))


#: Limits that make the given documents long: none is ranked in its row, or the longest
#: ones are ranked by rounds of joins.
JOINED = graph.Limits(row_local=8)
SPREAD = graph.Limits(row_local=40, row_ranked=80)


def edges_joined(spark, sf_dir):
    edges = graph.sentence_edges(spread_articles(spark, sf_dir), limits=JOINED)
    return edges.withColumn("weight", F.round("weight", DIGITS))


def pagerank_joined(spark, sf_dir):
    ranks = graph.pagerank_by_doc(spread_articles(spark, sf_dir), limits=JOINED)
    return ranks.withColumn("rank", F.round("rank", DIGITS))


def pagerank_spread(spark, sf_dir):
    ranks = graph.pagerank_by_doc(spread_articles(spark, sf_dir), limits=SPREAD)
    return ranks.withColumn("rank", F.round("rank", DIGITS))


def _summaries(spark, sf_dir, limits):
    found = summarize.summarize_articles(spread_articles(spark, sf_dir), limits=limits)
    ratio = F.round("compression_ratio", DIGITS).alias("compression_ratio")
    return found.select("ID", "summary", "summary_length", ratio)


def summaries_joined(spark, sf_dir):
    return _summaries(spark, sf_dir, JOINED)


def summaries_spread(spark, sf_dir):
    return _summaries(spark, sf_dir, SPREAD)


def textrank_summaries(spark, sf_dir):
    return summarize.textrank_summaries(spread_articles(spark, sf_dir)).select(
        "ID", "summary"
    )


def summarize_articles(spark, sf_dir):
    return _summaries(spark, sf_dir, graph.LIMITS)


def summary_stats(spark, sf_dir):
    return stats.rounded(
        stats.summary_stats(
            summarize.summarize_articles(spread_articles(spark, sf_dir))
        )
    )


def text_stats(spark, sf_dir):
    return stats.rounded(stats.text_stats(cleaned(spark, sf_dir)))


def nlp_stats(spark, sf_dir):
    return stats.rounded(stats.nlp_stats(clean.nlp_articles(cleaned(spark, sf_dir))))


_TOKENS = O.tokens('"Content"')
_CLEAN = O.clean('"Content"')

_NLP = f"""WITH {O.ARTICLES},
  c AS (SELECT "ID", {_CLEAN} AS cleaned_text FROM articles),
  t AS (SELECT "ID", {O.tokens('cleaned_text')} AS tokens FROM c),
  k AS (SELECT *, {O.no_stop('tokens')} AS kept FROM t),
  nlp AS (SELECT *, {O.stems('kept')} AS stems FROM k)"""

_RANKED_CONTENT = f"""WITH RECURSIVE {O.ARTICLES},
  {O.sentence_rows('s', 'articles', '"Content"')},
  {O.edges('g', 's')},
  {O.ranks('g')}"""

SQL = {
    "strip_html_pages": f"SELECT page_id, {O.strip_html('html')} AS body FROM pages",
    "clean_text_pages": f"SELECT page_id, {O.clean('html')} AS cleaned_text FROM pages",
    "clean_articles": f"""WITH {O.ARTICLES},
        c AS (SELECT "ID", {_CLEAN} AS cleaned_text FROM articles)
        SELECT "ID", cleaned_text, length(cleaned_text) AS text_length,
               {O.words('cleaned_text')} AS word_count FROM c""",
    "tokenize": f"""WITH {O.ARTICLES}, t AS (SELECT "ID", {_TOKENS} AS l FROM articles)
        SELECT "ID", {O.joined('l')} AS tokens, len(l) AS n FROM t""",
    "remove_stop_words": f"""WITH {O.ARTICLES}
        SELECT "ID", {O.joined(O.no_stop(_TOKENS))} AS tokens FROM articles""",
    "stem": f"""WITH {O.ARTICLES}
        SELECT "ID", {O.joined(O.stems(_TOKENS))} AS tokens FROM articles""",
    "processed_text": f"""WITH {O.ARTICLES}
        SELECT "ID", {O.joined(O.processed_list('"Content"'))} AS processed_text
        FROM articles""",
    "nlp_articles": f"""{_NLP}
        SELECT "ID", {O.joined('tokens')} AS tokens, {O.joined('kept')} AS tokens_no_stop,
               {O.joined('stems')} AS tokens_lemmatized,
               {O.joined('stems')} AS processed_text, len(tokens) AS token_count,
               len(kept) AS token_count_no_stop, len(stems) AS token_count_lemmatized
        FROM nlp""",
    "term_counts": f"""WITH {O.ARTICLES},
        t AS (SELECT "ID", unnest({_TOKENS}) AS term FROM articles)
        SELECT "ID", term, count(*) AS n FROM t GROUP BY ALL""",
    "preview_text": f"""WITH {O.ARTICLES}
        SELECT "ID",
          CASE WHEN length("Content") > 500 THEN left("Content", 500) || '...'
               ELSE "Content" END AS long_preview,
          CASE WHEN length("Content") > 300 THEN left("Content", 300) || '...'
               ELSE "Content" END AS short_preview
        FROM articles""",
    "split_sentences": f"""WITH {O.ARTICLES}, {O.sentence_rows('s', 'articles', '"Content"')}
        SELECT "ID", pos, s AS sentence FROM s""",
    "sentence_quality": f"""WITH {O.ARTICLES},
        {O.sentence_rows('s', 'articles', '"Content"')}, {O.scored('q', 's')}
        SELECT "ID", idx, pos, round(score, 6) AS score, s AS sentence FROM q""",
    "sentence_similarity": f"""WITH {O.ARTICLES},
        t AS (SELECT "ID", list_distinct({O.processed_list('"Title"')}) AS a,
                     list_distinct({O.processed_list('"Content"')}) AS b FROM articles),
        n AS (SELECT "ID", len(a) AS na, len(b) AS nb,
                     len(list_intersect(a, b)) AS c FROM t)
        SELECT "ID", CASE WHEN c > 0 THEN round(c / (na + nb - c)::DOUBLE, 6)
                          ELSE 0.0 END AS similarity FROM n""",
    "sentence_edges": f"""WITH {O.ARTICLES},
        {O.sentence_rows('s', 'articles', '"Content"')}, {O.edges('g', 's')}
        SELECT "ID", src, dst, round(weight, 6) AS weight FROM g_edges""",
    "pagerank_by_doc": f"""{_RANKED_CONTENT}
        SELECT "ID", node, round(x, 6) AS rank FROM g_ranks""",
    "textrank_summaries": f"""WITH RECURSIVE {O.ARTICLES},
        {O.summaries('articles', fixed=3)}
        SELECT "ID", summary FROM summaries""",
    "summarize_articles": f"""WITH RECURSIVE {O.ARTICLES}, {O.summaries('articles')}
        SELECT "ID", summary, summary_length,
               round(compression_ratio, 6) AS compression_ratio FROM summaries""",
    "summary_stats": f"""WITH RECURSIVE {O.ARTICLES}, {O.summaries('articles')}
        SELECT count(*) AS total_articles,
               count(*) FILTER (length(summary) > 0) AS articles_with_summaries,
               round(avg(summary_length) FILTER (summary_length > 0), 6)
                 AS avg_summary_length,
               min(summary_length) FILTER (summary_length > 0) AS min_summary_length,
               max(summary_length) FILTER (summary_length > 0) AS max_summary_length,
               round(avg(compression_ratio), 6) AS avg_compression_ratio,
               round(min(compression_ratio), 6) AS min_compression_ratio,
               round(max(compression_ratio), 6) AS max_compression_ratio
        FROM summaries""",
    "text_stats": f"""WITH {O.ARTICLES},
        c AS (SELECT {_CLEAN} AS t FROM articles),
        m AS (SELECT length(t) AS len, {O.words('t')} AS w FROM c)
        SELECT count(*) AS total_articles, count(*) FILTER (len > 0)
                 AS articles_with_content,
               round(avg(len), 6) AS average_text_length,
               round(avg(w), 6) AS average_word_count,
               min(len) AS min_text_length, max(len) AS max_text_length FROM m""",
    "nlp_stats": f"""{_NLP}
        SELECT count(*) AS total_articles,
               round(avg(len(tokens)), 6) AS average_tokens_per_article,
               round(avg(len(kept)), 6) AS average_tokens_no_stop,
               round(avg(len(stems)), 6) AS average_tokens_lemmatized,
               round(CASE WHEN sum(len(tokens)) > 0
                     THEN (sum(len(tokens)) - sum(len(kept)))::DOUBLE
                          / sum(len(tokens))::DOUBLE * 100
                     ELSE 0 END, 6) AS stop_words_removed_percentage
        FROM nlp""",
}

SQL["edges_joined"] = SQL["sentence_edges"]
SQL["pagerank_joined"] = SQL["pagerank_spread"] = SQL["pagerank_by_doc"]
SQL["summaries_joined"] = SQL["summaries_spread"] = SQL["summarize_articles"]

QUERIES = {
    function.__name__: function
    for function in (
        strip_html_pages,
        clean_text_pages,
        clean_articles,
        tokenize,
        remove_stop_words,
        stem,
        processed_text,
        nlp_articles,
        term_counts,
        preview_text,
        split_sentences,
        sentence_quality,
        sentence_similarity,
        sentence_edges,
        edges_joined,
        pagerank_by_doc,
        pagerank_joined,
        pagerank_spread,
        textrank_summaries,
        summarize_articles,
        summaries_joined,
        summaries_spread,
        summary_stats,
        text_stats,
        nlp_stats,
    )
}
