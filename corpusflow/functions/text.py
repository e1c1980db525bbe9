"""Scalar text functions: ``Column -> Column``, built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.expr import bind, sql_strings
from corpusflow.functions.words import STOP_WORDS

# Unicode letters, digits and underscore.  Java's own \w is ASCII only.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
# All Unicode white space.  Java's own \s is ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
TAG = r"<[^>]+>"

# Every suffix rule needs at least three characters before the suffix, and no
# two suffixes can end the same token, so one alternation covers all of them.
# The class in front turns most positions down at once, and the look back at the
# three characters comes last because it costs most.
_SUFFIX = r"(?=[iels])(?:ing|e(?:d|r|st)|ly|(?<!s)s)"
_AFTER_THREE = r"(?<=[^ ]{3}(?:ing|ed|er|est|ly|s))"
SUFFIX_AT_END = f"{_SUFFIX}${_AFTER_THREE}"
SUFFIX_IN_TEXT = f"{_SUFFIX}(?= |$){_AFTER_THREE}"

# The characters matched by SPACE, for trimming without a regular expression.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def empty_words() -> Column:
    return F.array().cast("array<string>")


def trim_space(col: Column) -> Column:
    """Strip Unicode white space at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def word_count(col: Column) -> Column:
    """Number of whitespace-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(f"{NOT_SPACE}+")), F.lit(0))


def is_blank(col: Column) -> Column:
    """True for null, empty and all-whitespace text."""
    return ~F.coalesce(col.rlike(NOT_SPACE), F.lit(False))


def strip_html(col: Column) -> Column:
    """Delete tags (nothing inserted), collapse white space, trim; null -> ''."""
    untagged = F.regexp_replace(F.coalesce(col, F.lit("")), TAG, "")
    return F.trim(F.regexp_replace(untagged, f"{SPACE}+", " "))


def clean_text(col: Column) -> Column:
    """Lower-case words separated by single spaces; tags and punctuation gone.

    A run of non-word characters (white space included) always ends up as one
    space, so replacing whole runs needs one pass instead of two.
    """
    untagged = F.regexp_replace(F.coalesce(col, F.lit("")), TAG, "")
    return F.lower(F.trim(F.regexp_replace(untagged, f"{NOT_WORD}+", " ")))


def cleaned_word_count(cleaned: Column) -> Column:
    """Word count of ``clean_text`` output: single spaces, no outer spaces."""
    spaces = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", 0).otherwise(spaces + 1)


def tokenize(col: Column) -> Column:
    """Lower-cased maximal runs of word characters; null or '' -> []."""
    lowered = F.lower(F.coalesce(col, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(f"{WORD}+"), F.lit(0))


def remove_stop_words(tokens: Column, stop: Sequence[str] = STOP_WORDS) -> Column:
    """Drop the tokens in ``stop``; order and repeats are kept; null -> []."""
    kept = bind(tokens, "ts", f"filter(ts, t -> t not in ({sql_strings(stop)}))")
    return F.coalesce(kept, empty_words())


def stem(tokens: Column) -> Column:
    """Cut one suffix (ing, ed, er, est, ly, s) off each token; null -> []."""
    stems = F.transform(tokens, lambda t: F.regexp_replace(t, SUFFIX_AT_END, ""))
    return F.coalesce(stems, empty_words())


def stem_text(joined: Column) -> Column:
    """``stem`` for tokens joined by single spaces, in one pass over the text."""
    return F.regexp_replace(joined, SUFFIX_IN_TEXT, "")


def processed_text(col: Column) -> Column:
    """tokenize -> remove stop words -> stem -> join with spaces."""
    return stem_text(F.array_join(remove_stop_words(tokenize(col)), " "))


def split_words(joined: Column) -> Column:
    """Tokens of space-joined text; '' -> []."""
    return F.when(joined == "", empty_words()).otherwise(F.split(joined, " "))


def preview_text(col: Column, limit: int) -> Column:
    """The first ``limit`` characters followed by '...' when text is longer."""
    short = F.concat(F.left(col, F.lit(limit)), F.lit("..."))
    return F.when(F.length(col) > limit, short).otherwise(col)


def strip_iso_marks(col: Column) -> Column:
    """``2024-01-15T10:30:00Z`` -> ``2024-01-15 10:30:00``."""
    return F.replace(F.replace(col, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))


def lenient_timestamp(col: Column) -> Column:
    """Local timestamp of a date text, null when it cannot be parsed."""
    return col.try_cast("timestamp_ntz")


def format_date(col: Column) -> Column:
    """``yyyy-MM-dd`` of a date text, null when it cannot be parsed."""
    return lenient_timestamp(col).cast("date").cast("string")
