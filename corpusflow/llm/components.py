"""Connected components by alternating star contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common

MAX_ROUNDS = 100


def _stars(pairs: DataFrame, at: str, other: str, name: str) -> DataFrame:
    """Every pair with ``least``, the smallest node in the star around ``at``.

    The minima are combined before the shuffle and written, so both sides of the join
    are plain exchanges: a star with a large part of all pairs is split at run time.
    """
    least = pairs.groupBy(F.col(at).alias("centre")).agg(F.min(other).alias("m"))
    least = common.stored(least.select("centre", F.least("centre", "m").alias("least")), name)
    return pairs.join(least, pairs[at] == least["centre"]).select(at, other, "least")


def _fingerprint(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(
        F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")
    ).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``links(u, v)``; component: the smallest node.

    Nodes are long. Each round hangs the larger neighbours of a node, then the smaller
    ones, on the smallest node around; the number of links never grows, and the rounds
    end when every node hangs on its component's smallest node. Links are stored
    between rounds, so a lost executor costs a read.
    """
    turned = links.filter("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    pairs = common.stored(turned.distinct(), "links")
    before = _fingerprint(pairs)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, "u", "v", "large").filter("v > u and v != least")
        hung = large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        hung = common.stored(hung, "links")
        small = _stars(hung, "u", "v", "small")
        moved = small.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        own = small.select("u", F.col("least").alias("v"))
        pairs = common.stored(moved.unionByName(own).distinct(), "links")
        after = _fingerprint(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots.distinct())
