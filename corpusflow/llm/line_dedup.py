"""Line de-duplication by prefix doubling over sequences of line IDs.

The lines with a word of each document are a sequence of line IDs. Doubling names the
prefixes of all suffixes: suffixes that share their first 2**k lines get the same name,
and a pair of names, 2**k lines apart, names twice as many lines. Suffixes whose prefix
occurs once drop out at each step, so only repeated text goes on. The suffixes with one
name are an interval of the suffix array whose common prefixes have at least that
length; two overlapping names reach any depth. The intervals at the depth asked for
hold exactly the maximal repeated runs of at least that many lines, so doubling stops
there: deeper names could not change which lines are copies.

All copies of a run but the first (by document id, then line) are deleted, and so are
later copies of a single line with many characters. Blank lines are no part of a run
and stay.

Null texts are empty and keep being null; a null id comes first in the order. Rows that
repeat an id and its text are one document, listed more than once: they get the same
result and are no copies of each other. Rows with the same id and different texts are
different documents, in the order of a hash of the text. Other columns are kept.
Only built-in functions, joins, windows inside a document and aggregations are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import common

MIN_LINES = 3
LONG_LINE_CHARS = 100
PLACE = ("id", "h", "n")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, h, n, raw, content, long)``: the ``n``-th line with a word, line ``raw``."""
    text = common.text_or_empty(text_col)
    source = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.split(text, "\n").alias("lines")
    )
    worded = F.filter(
        F.transform("lines", lambda line, k: F.struct(k.alias("raw"), line.alias("line"))),
        lambda entry: entry["line"].rlike(f"[^{common.SPACE_CLASS}]"),
    )
    return source.select("id", "h", F.posexplode(worded).alias("n", "at")).select(
        *PLACE,
        F.col("at.raw").alias("raw"),
        F.unhex(F.md5("at.line")).alias("content"),
        F.length("at.line").alias("chars"),
    )


def _named(rows: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """Rows whose ``keys`` occur more than once, with a name and the first place of them.

    Counts are combined before the shuffle and written with their names; the join back
    then has two plain exchanges, so a line with a large part of all rows is split.
    """
    found = rows.groupBy(*keys).agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("c"))
    names = found.filter("c > 1").select(
        *keys, F.monotonically_increasing_id().alias("name_"), "first"
    )
    named = rows.join(common.stored(names, "names"), keys)
    return named.select(*PLACE, *kept, F.col("name_").alias("name"), "first")


def _ahead(active: DataFrame, lines: int) -> DataFrame:
    """Suffixes with the name of the suffix some lines further on."""
    ordered = Window.partitionBy("id", "h").orderBy("n").rangeBetween(lines, lines)
    paired = active.withColumn("next", F.max("name").over(ordered)).filter("next is not null")
    return common.stored(paired.select(*PLACE, "name", "next"), "paired")


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    long_line_chars: int = LONG_LINE_CHARS,
) -> DataFrame:
    """``(id, h, raw, first_id)``: the lines that are later copies.

    ``h`` is a hash of the text, ``first_id`` the document of a first copy.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be positive")
    lines = common.stored(_lines(docs, id_col, text_col), "lines")
    single = common.stored(_named(lines, ["content"], ["raw", "chars"]), "single")
    runs, depth = single.select(*PLACE, "name", "first"), 1
    while 2 * depth <= min_lines:
        runs = common.stored(_named(_ahead(runs, depth), ["name", "next"], []), "runs")
        depth *= 2
    if depth < min_lines:
        runs = _named(_ahead(runs, min_lines - depth), ["name", "next"], [])
    later = F.struct(*PLACE) > F.col("first")
    starts = runs.filter(later).select(*PLACE, F.col("first.id").alias("run_id"), F.lit(1).alias("run"))
    own = F.when(later & (F.col("chars") >= long_line_chars), F.col("first.id"))
    lone = F.when(later & (F.col("chars") >= long_line_chars), 1)
    every = single.select(*PLACE, "raw", lone.alias("lone"), own.alias("own_id")).unionByName(
        starts, allowMissingColumns=True
    )
    cover = Window.partitionBy("id", "h").orderBy("n").rangeBetween(1 - min_lines, 0)
    marked = every.select(
        "id",
        "h",
        "raw",
        F.coalesce("lone", F.max("run").over(cover)).alias("copy"),
        F.coalesce("own_id", F.min("run_id").over(cover)).alias("first_id"),
    )
    return marked.filter("raw is not null and copy = 1").drop("copy")


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    long_line_chars: int = LONG_LINE_CHARS,
    report: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with later copies of lines taken out of ``text_col``.

    ``report`` names two columns to add: the number of lines deleted, and the sorted
    ids of the documents that have the first copies.
    """
    found = repeated_lines(docs, id_col, text_col, min_lines, long_line_chars)
    gone, first, key, digest, place = common.fresh(
        docs, "_gone", "_first", "_key", "_digest", "_line"
    )
    per_doc = found.groupBy(F.col("id").alias(key), F.col("h").alias(digest)).agg(
        F.collect_set("raw").alias(gone), F.sort_array(F.collect_set("first_id")).alias(first)
    )
    hashed = docs.withColumn(digest + "_", F.xxhash64(common.text_or_empty(text_col)))
    same = hashed[id_col].eqNullSafe(per_doc[key]) & (hashed[digest + "_"] == per_doc[digest])
    joined = hashed.join(per_doc, same, "left")
    lines = F.split(F.col(text_col), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rebuilt = F.array_join(F.transform(kept, lambda k: F.get(F.col(place), k)), "\n")
    joined = joined.withColumn(place, F.when(F.col(gone).isNotNull(), lines))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(rebuilt)
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if report:
        columns += [
            F.coalesce(F.size(gone), F.lit(0)).alias(report[0]),
            F.coalesce(first, F.array()).alias(report[1]),
        ]
    return joined.select(*columns)
