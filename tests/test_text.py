import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.functions import words
from corpusflow.operators import clean, stats


def test_word_list_sizes():
    assert len(set(words.STOP_WORDS)) == len(words.STOP_WORDS) == 102
    assert len(words.TOPIC_STOP_WORDS) == 432
    assert set(words.STOP_WORDS) <= set(words.TOPIC_STOP_WORDS)
    assert len(set(words.GENERIC_KEYWORDS)) == 122
    assert not {"she", "her", "his", "about", "into", "which", "who"} & set(
        words.STOP_WORDS
    )


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("<ul><li>Rain</li> <li>falls <i>hard</i></li></ul>", "rain falls hard"),
        ("Pay 5% + $3 @ Jo's #1 shop?", "pay 5 3 jo s 1 shop"),
        ("one\t two\r\n\n three", "one two three"),
        ("Nine of 10 doors...", "nine of 10 doors"),
        ("snake_case Élan, çà là", "snake_case élan çà là"),
        ("", ""),
        ("   ", ""),
        (None, ""),
    ],
)
def test_clean_text(value, raw, expected):
    assert value(lambda c: T.clean_text(F.col(c)), raw) == expected


def test_strip_html_inserts_nothing(value):
    assert value(lambda c: T.strip_html(F.col(c)), "<p>a</p><p>b</p>  c\n") == "ab c"
    assert value(lambda c: T.strip_html(F.col(c)), None) == ""


def test_tokens(value):
    text = "farmers near the river plant an early crop"
    assert value(lambda c: T.tokenize(F.col(c)), text) == text.split()
    assert value(lambda c: T.tokenize(F.col(c)), "It's A_1, ok") == ["it", "s", "a_1", "ok"]
    assert value(lambda c: T.tokenize(F.col(c)), None) == []
    assert value(lambda c: T.tokenize(F.col(c)), "") == []


def test_stop_words_keep_order_and_repeats(value):
    kept = value(
        lambda c: T.remove_stop_words(T.tokenize(F.col(c))),
        "the farmers have planted a crop crop near it",
    )
    assert kept == ["farmers", "planted", "crop", "crop", "near"]


STEMS = {
    "running": "runn",
    "better": "bett",
    "discovered": "discover",
    "harvests": "harvest",
    "king": "king",
    "seeing": "see",
    "going": "going",
    "red": "red",
    "used": "used",
    "faded": "fad",
    "over": "over",
    "later": "lat",
    "best": "best",
    "rest": "rest",
    "latest": "lat",
    "fly": "fly",
    "only": "only",
    "early": "ear",
    "gas": "gas",
    "cars": "car",
    "class": "class",
    "ss": "ss",
    "écoles": "école",
}


def test_stem_rules(value):
    joined = " ".join(STEMS)
    expected = list(STEMS.values())
    assert value(lambda c: T.stem(F.split(c, " ")), joined) == expected
    assert value(lambda c: T.stem_text(F.col(c)), joined) == " ".join(expected)


def test_processed_text(value):
    text = "The farmers have planted growing crops."
    assert (
        value(lambda c: T.processed_text(F.col(c)), text)
        == "farmer plant grow crop"
    )
    assert value(lambda c: T.processed_text(F.col(c)), "the and of") == ""


def test_previews_and_dates(value):
    assert value(lambda c: T.preview_text(F.col(c), 3), "abcd") == "abc..."
    assert value(lambda c: T.preview_text(F.col(c), 4), "abcd") == "abcd"
    stamp = "2024-01-15T10:30:00Z"
    assert value(lambda c: T.strip_iso_marks(F.col(c)), stamp) == "2024-01-15 10:30:00"
    assert value(lambda c: T.format_date(F.col(c)), "2024-01-15 10:30:00") == "2024-01-15"
    assert value(lambda c: T.format_date(F.col(c)), "soon") is None


def test_word_counts(value):
    assert value(lambda c: T.word_count(F.col(c)), " a b\tc ") == 3
    assert value(lambda c: T.word_count(F.col(c)), None) == 0
    assert value(lambda c: T.is_blank(F.col(c)), "  \n") is True
    assert value(lambda c: T.is_blank(F.col(c)), None) is True
    assert value(lambda c: T.is_blank(F.col(c)), ".") is False


def _frame(spark, *texts):
    rows = list(enumerate(texts, 1))
    return spark.createDataFrame(rows, "ID bigint, Content string")


def test_article_columns(spark):
    df = clean.nlp_articles(
        clean.clean_articles(_frame(spark, "<p>The cats</p> running!", None))
    )
    first, second = df.orderBy("ID").collect()
    assert first["cleaned_text"] == "the cats running"
    assert (first["text_length"], first["word_count"]) == (16, 3)
    assert first["tokens"] == ["the", "cats", "running"]
    assert first["tokens_no_stop"] == ["cats", "running"]
    assert first["tokens_lemmatized"] == ["cat", "runn"]
    assert first["processed_text"] == "cat runn"
    assert (first["token_count"], first["token_count_lemmatized"]) == (3, 2)
    assert (second["cleaned_text"], second["word_count"]) == ("", 0)
    assert second["tokens"] == second["tokens_lemmatized"] == []


def test_nlp_needs_cleaned_text(spark):
    df = _frame(spark, "a")
    assert clean.nlp_articles(df).columns == df.columns


def test_term_counts(spark):
    df = spark.createDataFrame([(1, ["A", "b", "a"]), (2, [])], "ID int, tokens array<string>")
    rows = {(r["ID"], r["term"]): r["n"] for r in clean.term_counts(df).collect()}
    assert rows == {(1, "a"): 2, (1, "b"): 1}


def test_nlp_stats(spark):
    df = spark.createDataFrame(
        [(3, 2, 2), (3, 3, 3)],
        "token_count int, token_count_no_stop int, token_count_lemmatized int",
    )
    row = stats.nlp_stats(df).first()
    assert row["total_articles"] == 2
    assert row["average_tokens_per_article"] == 3.0
    assert row["average_tokens_no_stop"] == row["average_tokens_lemmatized"] == 2.5
    assert row["stop_words_removed_percentage"] == pytest.approx(100 / 6)
    empty = stats.nlp_stats(df.limit(0)).first()
    assert empty["stop_words_removed_percentage"] == 0.0


def test_summary_stats(spark):
    df = spark.createDataFrame(
        [("a b c d e", 5, 0.1), ("", 0, 0.0), ("x y z", 3, 0.15)],
        "summary string, summary_length int, compression_ratio double",
    )
    row = stats.summary_stats(df).first()
    assert (row["total_articles"], row["articles_with_summaries"]) == (3, 2)
    assert row["avg_summary_length"] == 4.0
    assert (row["min_summary_length"], row["max_summary_length"]) == (3, 5)
    assert row["avg_compression_ratio"] == pytest.approx(0.25 / 3)
    assert (row["min_compression_ratio"], row["max_compression_ratio"]) == (0.0, 0.15)
