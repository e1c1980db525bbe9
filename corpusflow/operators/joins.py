"""Copying columns between frames by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def update_by_key(
    df: DataFrame,
    updates: DataFrame,
    columns: Sequence[str],
    order: str,
    key: str = "ID",
) -> DataFrame:
    """Replace ``columns`` where ``updates`` has the key; other rows stay.

    Of several updates for a key the one with the largest ``order`` wins.  They
    are combined before the shuffle, so a key updated very often is cheap.
    """
    values = F.struct(*(F.col(name) for name in columns))
    last = updates.groupBy(key).agg(F.max_by(values, order).alias("_update"))
    return replace_by_key(df, last, columns, key)


def replace_by_key(
    df: DataFrame, last: DataFrame, columns: Sequence[str], key: str = "ID"
) -> DataFrame:
    """Replace ``columns`` by those in the struct ``_update`` of ``last``, unique by key."""
    joined = df.join(last, key, "left")

    def value(name: str):
        if name not in columns:
            return F.col(f"`{name}`")
        new = F.col("_update").getField(name)
        if name not in df.columns:
            return new.alias(name)
        kept = F.when(F.col("_update").isNull(), F.col(f"`{name}`"))
        return kept.otherwise(new).alias(name)

    added = [name for name in columns if name not in df.columns]
    return joined.select(*(value(name) for name in [*df.columns, *added]))
