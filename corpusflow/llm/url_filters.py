"""URL filter lists with dates, evaluated as of each capture's fetch time.

List entries say from which day on a host pattern is blocked, allowed or lifted again. An
entry holds until the next one for its pattern, which turns the list into validity
intervals. A capture is judged by the entries active on its day: of those that cover its
host, the one with the longest pattern decides.

Captures are reduced to distinct pairs of host and day before the as-of join, and the
join runs over one pattern's entries and days, which the calendar bounds, however many
captures a host has. Their verdicts go back to the captures by an ordinary join that can
be split at run time.

A pattern covers its host and all hosts below it. Hosts are lower-cased; user names,
ports and a final dot are left out. A capture with a null or odd URL, or without a day,
has no verdict. If several entries name a pattern on one day, the one with the largest
``entry_id`` holds. Repeated captures are judged one by one; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import common

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: str | Column) -> Column:
    """The host of a URL; null if there is none."""
    column = F.col(url) if isinstance(url, str) else url
    host = F.rtrim(F.lower(F.regexp_extract(column, HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def covering(host: str) -> Column:
    """The host and the domains above it."""
    labels = F.split(F.col(host), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """``(pattern, action, since, until)`` from ``entries(pattern, action, day, entry_id)``.

    ``until`` is exclusive, null for an entry that still holds.
    """
    known = entries.filter("pattern is not null and day is not null and action is not null")
    daily = known.groupBy("pattern", "day").agg(
        F.max_by("action", F.struct("entry_id", "action")).alias("action")
    )
    following = Window.partitionBy("pattern").orderBy("day")
    return daily.select(
        "pattern", "action", F.col("day").alias("since"), F.lead("day").over(following).alias("until")
    )


def verdicts(pairs: DataFrame, valid: DataFrame) -> DataFrame:
    """``(host, day, verdict, pattern, since)`` for ``pairs(host, day)`` that an entry covers."""
    asked = pairs.select("host", "day", F.explode(covering("host")).alias("pattern"))
    # captures come behind the entry of their own day
    marks = valid.select(
        "pattern", F.col("since").alias("day"), F.lit(0).alias("asked"), "action", "since"
    ).unionByName(
        asked.select("pattern", "day", F.lit(1).alias("asked")).distinct(), allowMissingColumns=True
    )
    so_far = Window.partitionBy("pattern").orderBy("day", "asked")
    active = marks.select(
        "pattern",
        "day",
        "asked",
        F.last("action", ignorenulls=True).over(so_far).alias("verdict"),
        F.last("since", ignorenulls=True).over(so_far).alias("since"),
    ).filter("asked = 1 and verdict in ('block', 'allow')")
    met = asked.join(active.drop("asked"), ["pattern", "day"])
    deciding = F.struct(F.length("pattern").alias("length"), "verdict", "pattern", "since")
    best = met.groupBy("host", "day").agg(F.max(deciding).alias("best"))
    return best.select("host", "day", "best.verdict", "best.pattern", "best.since")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "day") -> DataFrame:
    """Adds ``host``, ``verdict`` (block, allow or none), ``pattern`` and ``since`` to captures."""
    host, day, pattern, since, verdict = common.fresh(
        captures, "_host", "_day", "_pattern", "_since", "_verdict"
    )
    hosted = captures.withColumn(host, host_of(url_col)).withColumn(day, F.col(day_col))
    pairs = hosted.filter(F.col(host).isNotNull() & F.col(day).isNotNull()).select(
        F.col(host).alias("host"), F.col(day).alias("day")
    )
    judged = common.stored(verdicts(pairs.distinct(), intervals(entries)), "verdicts")
    right = judged.select(
        F.col("host").alias("of_host"),
        F.col("day").alias("of_day"),
        F.col("verdict").alias(verdict),
        F.col("pattern").alias(pattern),
        F.col("since").alias(since),
    )
    same = (F.col(host) == right["of_host"]) & (F.col(day) == right["of_day"])
    added = {"host": F.col(host), "verdict": F.coalesce(verdict, F.lit("none")), "pattern": F.col(pattern), "since": F.col(since)}
    kept = [hosted[c] for c in captures.columns if c not in added]
    joined = hosted.join(right, same, "left")
    return joined.select(*kept, *(column.alias(name) for name, column in added.items()))
