"""Sentence functions: ``Column -> Column``, evaluated inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.expr import bind, let, sql_strings
from corpusflow.functions.text import (
    NOT_SPACE,
    SPACE,
    SPACE_CHARS,
    SUFFIX_IN_TEXT,
    WORD,
    processed_text,
    split_words,
    trim_space,
)
from corpusflow.functions.words import STOP_WORDS

NOT_WORD_OR_MARK = r"[^\p{L}\p{N}_\x01]+"

# A sentence ends at '.', '?' or '!' followed by white space, unless the mark
# closes an abbreviation of the kind "U.S." or "Dr.".
BOUNDARY = rf"(?<=[.?!])(?<!{WORD}\.{WORD}.)(?<![A-Z][a-z]\.){SPACE}+"

# --- fixed values: what counts as a readable sentence ----------------------
MIN_WORDS = 10
MIN_WORDS_WITH_TIMESTAMP = 20
MIN_WORDS_COMMENT = 15
# \x27 is the apostrophe, which would end a SQL string.
COMMENT_START = r"^Here\x27s"
TIMESTAMP = rf"\p{{Nd}}+\.\p{{Nd}}+pm?{SPACE}+BST"
TIMESTAMP_START = rf"^(?:Updated at )?{TIMESTAMP}"
FRAGMENT_START = r"^(?:Here\x27s|Updated at|Judges\x27|Best dance)"
POINTS_PER_WORD = 0.1
MAX_LENGTH_POINTS = 5.0
TIMESTAMP_PENALTY = 0.5
# ---------------------------------------------------------------------------


def split_sentences(col: Column) -> Column:
    """Trimmed, non-empty sentences in text order; null or blank -> []."""
    text = trim_space(F.coalesce(col, F.lit("")))
    return F.filter(F.split(text, BOUNDARY), lambda s: s != "")


def max_sentences(col: Column) -> Column:
    """Cheap upper bound on ``size(split_sentences(col))``: marks plus one."""
    text = F.coalesce(col, F.lit(""))
    unmarked = text
    for mark in ".?!":
        unmarked = F.replace(unmarked, F.lit(mark), F.lit(""))
    return F.length(text) - F.length(unmarked) + 1


def sql_split(text: str) -> str:
    """``split_sentences`` as SQL text."""
    trimmed = f"btrim(coalesce({text}, ''), '{SPACE_CHARS}')"
    return f"filter(split({trimmed}, r'{BOUNDARY}'), s -> s <> '')"


def sql_scored(sentences: str) -> str:
    """``score_sentences`` as SQL text."""
    described = f"""transform({sentences}, (s, i) -> named_struct(
        'pos', i,
        'sentence', s,
        'words', regexp_count(s, r'{NOT_SPACE}+'),
        'stamps', if(contains(s, 'BST'), regexp_count(s, r'{TIMESTAMP}'), 0)))"""
    readable = f"""filter({described}, s ->
        s.words >= {MIN_WORDS}
        and not (s.stamps > 0 and (s.words < {MIN_WORDS_WITH_TIMESTAMP}
                                   or s.sentence rlike r'{TIMESTAMP_START}'))
        and not (s.words < {MIN_WORDS_COMMENT}
                 and s.sentence rlike r'{COMMENT_START}'))"""
    points = f"""least(s.words * {POINTS_PER_WORD}D, {MAX_LENGTH_POINTS}D)
        + if(s.sentence rlike r'^\\p{{IsUppercase}}', 1.0D, 0.0D)
        + if(s.sentence rlike r'[.!?]$', 1.0D, 0.0D)
        - s.stamps * {TIMESTAMP_PENALTY}D
        + if(s.sentence rlike r'{FRAGMENT_START}', 0.0D, 1.0D)"""
    return f"""sort_array(transform({readable}, s -> named_struct(
        'rank_key', -({points}), 'pos', s.pos, 'sentence', s.sentence)))"""


def score_sentences(sentences: Column) -> Column:
    """Readable sentences with their score, best first, earlier first on ties.

    Result: ``array<struct<rank_key double, pos int, sentence string>>`` where
    ``rank_key`` is the negated score, so the natural sort order is the order
    wanted.
    """
    return bind(sentences, "ss", sql_scored("ss"))


def sentence_tokens(sentence: Column) -> Column:
    """Distinct processed tokens of one sentence."""
    return F.array_distinct(split_words(processed_text(sentence)))


def sql_token_sets(sentences: str) -> str:
    """``token_sets`` as SQL text; ``sentences`` is the name of a bound value."""
    mark = "\x01"
    stop = sql_strings(("", *STOP_WORDS))
    unmarked = f"transform({sentences}, s -> translate(s, '{mark}', ' '))"
    text = f"lower(array_join({unmarked}, ' {mark} '))"
    words = f"split(regexp_replace({text}, r'{NOT_WORD_OR_MARK}', ' '), ' ')"
    kept = f"array_join(filter({words}, w -> w not in ({stop})), ' ')"
    stems = f"regexp_replace({kept}, r'{SUFFIX_IN_TEXT}', '')"
    sets = f"""transform(split({stems}, '{mark}'), s -> if(
        trim(s) = '', cast(array() as array<string>),
        array_distinct(split(trim(s), ' '))))"""
    none = "cast(array() as array<array<string>>)"
    return f"if(size({sentences}) = 0, {none}, {sets})"


def token_sets(sentences: Column) -> Column:
    """``sentence_tokens`` of each sentence: ``array<array<string>>``.

    The sentences go through the token steps as one text, kept apart by a mark
    that no step removes, so a step runs once per article and not per sentence.
    """
    return bind(sentences, "ss", sql_token_sets("ss"))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two token sets; 0.0 when they share nothing."""
    shared = F.size(F.array_intersect(left, right))
    return let(
        shared,
        lambda n: F.when(
            n > 0, n.cast("double") / (F.size(left) + F.size(right) - n)
        ).otherwise(0.0),
    )


def sentence_similarity(left: Column, right: Column) -> Column:
    """Jaccard similarity of two texts; 0.0 when either is null or empty."""
    score = jaccard(sentence_tokens(left), sentence_tokens(right))
    return F.coalesce(score, F.lit(0.0))
