"""Exact duplicates: two Bloom passes find the rows that may repeat; only those shuffle.

A pass hashes every digest to one of ``CELLS_PER_ROW`` cells a row, counts the rows of
each cell (combined before the shuffle, a few bytes a cell) and keeps the cells that two
rows or more hit, as bitmaps.  A row whose cell is not set has no equal row.  The second
pass does the same to the rows that are left, with another hash.  What passes both is
grouped by its digest, so a false alarm costs a shuffled row and nothing else.

The bitmaps are broadcast.  Their size is fixed by ``MAX_FILTER_BYTES``: a table with
more rows is worked off in slices of the hash range, one filter after the other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common
from corpusflow.sources.scratch import scratch_path

#: Cells of the filter for each row that goes in: one in nine single rows is a false
#: alarm of a pass, and one in seventy of both.
CELLS_PER_ROW = 8
#: Bytes of bitmaps that are sent to every executor at once.
MAX_FILTER_BYTES = 64 << 20
#: Bits of Spark's bitmaps.
BITMAP_BITS = 32768
SEEDS = ("first pass", "second pass")


def normalized(text: Column) -> Column:
    """Every run of white space is one space."""
    return F.regexp_replace(text, rf"[{common.SPACE_CLASS}]+", " ")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, row, digest)``; ``row`` tells rows apart that repeat an id."""
    texts = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    return texts.select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.sha2(normalized(F.col("text")).cast("binary"), 256).alias("digest"),
    )


def _placed(rows: DataFrame, seed: str, slices: int, bitmaps: int) -> DataFrame:
    """Adds the slice, the bitmap and the bit in it of every digest."""
    hashed = F.xxhash64("digest", F.lit(seed))
    cell = F.pmod(hashed, F.lit(slices * bitmaps * BITMAP_BITS)) + 1
    bucket = F.bitmap_bucket_number(cell) - 1
    return rows.select(
        "*",
        F.pmod(bucket, F.lit(slices)).alias("slice"),
        bucket.alias("bucket"),
        F.bitmap_bit_position(cell).alias("bit"),
    )


def _hit_again(placed: DataFrame) -> DataFrame:
    """``(hit, bitmap)``: the cells that at least two rows hit."""
    counts = placed.groupBy("bucket", "bit").agg(F.count("*").alias("n"))
    # Single cells now: all bits of a bitmap come together before they are set.
    often = counts.filter("n > 1").repartition("bucket")
    return often.groupBy(F.col("bucket").alias("hit")).agg(
        F.bitmap_construct_agg("bit").alias("bitmap")
    )


def _bit(bitmap: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set; never null."""
    byte = F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(value.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0, F.lit(False))


def bloom_pass(
    rows: DataFrame, seed: str, max_filter_bytes: int = MAX_FILTER_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Rows whose digest certainly is alone, and rows whose digest may repeat."""
    spark = rows.sparkSession
    bitmaps = max(1, math.ceil(rows.count() * CELLS_PER_ROW / BITMAP_BITS))
    slices = math.ceil(bitmaps / max(1, max_filter_bytes * 8 // BITMAP_BITS))
    per_slice = math.ceil(bitmaps / slices)
    placed = _placed(rows, seed, slices, per_slice)
    path = scratch_path(spark, "bloom")
    for number in range(slices):
        part = placed.filter(F.col("slice") == number)
        # At most per_slice rows of 4096 bytes.
        filter_ = F.broadcast(common.stored(_hit_again(part), "filter"))
        probed = part.join(filter_, F.col("bucket") == F.col("hit"), "left")
        flagged = probed.select(*rows.columns, _bit(F.col("bitmap"), F.col("bit")).alias("again"))
        flagged.write.mode("append").partitionBy("again").parquet(path)
    schema = rows.schema.add("again", "boolean")
    done = spark.read.schema(schema).parquet(path)
    return done.filter("not again").drop("again"), done.filter("again").drop("again")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Texts are equal if they are identical after every run of white space became one
    space; a null text is empty, and all empty texts are equal.  Of equal texts one row
    stays, that with the smallest id: rows without an id come last, and of rows that
    repeat an id one stays, whichever it is.  ``keep_id`` is null if no row of the group
    has an id.  Whole texts are read, however long; further columns are left alone.  An
    empty table gives no rows.
    """
    rows = common.stored(_digests(docs, id_col, text_col), "digests")
    alone = []
    for seed in SEEDS:
        single, rows = bloom_pass(rows, seed, max_filter_bytes)
        alone.append(single)

    # One row per digest and task goes into this shuffle, however large the group.
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
    groups = rows.groupBy(F.col("digest").alias("same")).agg(
        first.alias("first"), F.count("*").alias("n")
    )
    groups = common.stored(groups, "groups").hint("merge")
    # Plain exchanges on both sides: a digest with very many rows is split at run time.
    met = rows.join(groups, rows["digest"] == groups["same"])
    repeated = met.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    single = alone[0].unionByName(alone[1]).select(
        F.col("id").alias(id_col),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return single.unionByName(repeated)
