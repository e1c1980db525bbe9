"""Ranking, de-duplication and dense numbering."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.sources.scratch import fixed


def top_n(
    df: DataFrame,
    order: Sequence[Column | str],
    n: int,
    partition: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows by ``order``, per partition if one is given.

    Spark keeps only ``n`` rows per partition value on the map side (window group
    limit), so a value holding a third of all rows does not travel as a whole.
    """
    if not partition:
        return df.orderBy(*order).limit(n)
    window = Window.partitionBy(*partition).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def dedup_by_title(df: DataFrame, title: str = "Title", key: str = "ID") -> DataFrame:
    """The first row (smallest key) of each exact title; null is one title.

    Only keys and titles are compared; the rows themselves meet the chosen keys.
    """
    first = df.groupBy(F.col(title).alias("_title")).agg(F.min(key).alias("_first"))
    same = F.col(title).eqNullSafe(F.col("_title")) & F.col(key).eqNullSafe(F.col("_first"))
    return df.join(first, same, "left_semi")


def assign_ids(
    df: DataFrame,
    start: int | Callable[[int], int],
    order: Sequence[str | Column],
    key: str = "ID",
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in the given order.

    ``start`` may be a function of the number of rows, called once they are counted.

    Rows are range-partitioned and sorted, and written once with their partition and
    their place in it, from which they are numbered; only the row count of each
    partition is collected.  Rows equal in ``order`` are ordered by their
    content; identical rows, which may be many, are spread by a random value.
    A sample of the order columns comes to the driver: give it short ones.
    """
    tie = F.xxhash64(*(f"`{name}`" for name in df.columns))
    salted = df.withColumns({"_tie": tie, "_salt": F.rand(0)})
    columns = [F.col(f"`{c}`") if isinstance(c, str) else c for c in (*order, "_tie", "_salt")]
    ordered = salted.repartitionByRange(*columns).sortWithinPartitions(*columns)
    ordered = ordered.drop("_tie", "_salt", key)
    # The generated id holds the partition above bit 33 and the row below it.
    row = F.monotonically_increasing_id()
    marked = ordered.withColumns(
        {
            "_part": F.shiftright(row, 33),
            "_row": row.bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    marked = fixed(marked, "numbered")
    counts = marked.groupBy("_part").agg(F.count("*").alias("n")).collect()
    offsets = []
    before = start(sum(part["n"] for part in counts)) if callable(start) else start
    for part in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((part["_part"], before))
        before += part["n"]
    if not offsets:
        return marked.withColumn(key, F.lit(None).cast("bigint")).select(key, *ordered.columns)
    table = df.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    # One row per partition; of unknown size to Spark, which would move all rows to meet it.
    numbered = marked.join(F.broadcast(table), "_part")
    return numbered.select(
        (F.col("_offset") + F.col("_row") + 1).alias(key), *ordered.columns
    )
