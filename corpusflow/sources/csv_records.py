"""Records of CSV files whose quoted fields hold line breaks, from splittable reads.

Spark reads such a file as a whole, in one task.  Here lines are read, by as many tasks as
the file has splits.  A line starts a record if the quotes before it in its file are even
in number, which one count for each split tells.  Lines are put together where they are
read; only the pieces of records that cross the border of a split meet elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.sources import workers

QUOTE = '"'
PIECES = "file string, start long, whole boolean, first boolean, header boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, line)``: ``start`` is where the split begins that a line is read in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def _joiner(odd: dict[tuple[str, int], bool]):
    """Lines to whole records and pieces; ``odd``: whether a split begins inside quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, held, first, header = None, False, [], False, False
        out: list[tuple] = []

        def piece(whole: bool) -> None:
            out.append((*split, whole, first, header, "\n".join(held)))

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(3))
            for file, start, line in zip(*columns):
                if (file, start) != split:
                    if held:
                        piece(whole=False)
                    split, inside, held = (file, start), odd[file, start], []
                    first = not inside  # else its first lines end an earlier split's record
                    header = start == 0
                held.append(line)
                if line.count(QUOTE) % 2:
                    inside = not inside
                if not inside:
                    piece(whole=first)
                    held, first, header = [], True, False
            yield _rows(out)
            out = []
        if held:
            piece(whole=False)
        yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file", "start", "whole", "first", "header", "record"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(header, record)``: the text of each record; ``header``: it is its file's first.

    Quotes stand around fields, and doubled inside of them.  A file that ends inside
    quotes ends its last record there.
    """
    workers.find_package(spark)
    lines = _lines(spark, path)
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    # One row for each split comes to the driver, as the splits themselves do.
    counts = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd")).collect()
    odd: dict[tuple[str, int], bool] = {}
    file, inside = None, False
    for row in sorted(counts, key=lambda r: (r["file"], r["start"])):
        if row["file"] != file:
            file, inside = row["file"], False
        odd[row["file"], row["start"]] = inside
        inside ^= bool(row["odd"])
    found = lines.mapInArrow(_joiner(odd), PIECES)
    # A split has two pieces at most; a piece that begins a record opens a new group.
    order = Window.partitionBy("file").orderBy("start", "first")
    pieces = found.filter("not whole").withColumn("n", F.sum(F.col("first").cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("start", "first", "record")))
    joined = pieces.groupBy("file", "n").agg(
        F.bool_or("header").alias("header"), F.array_join(parts["record"], "\n").alias("record")
    )
    whole = found.filter("whole").select("header", "record")
    return whole.unionByName(joined.select("header", "record"))
