"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score int, id int, block int, v int"


def brute(rows, is_anchor):
    fine = [
        (i, [math.floor(H.SCALE * x) for x in v], label)
        for i, v, label in rows
        if i is not None
        and label is not None
        and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for a, (i, v, label) in enumerate(fine):
        if not is_anchor(i):
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j, other)
            for b, (j, w, other) in enumerate(fine)
            if a != b
        ]
        scored.sort()
        positives = [(s, j) for s, j, other in scored if other == label][: H.POSITIVES]
        for p, j in positives:
            hard = [
                (s, n)
                for s, n, other in scored
                if other != label and 80 * -p <= 100 * -s <= 100 * -p
            ]
            found += [(i, j, r + 1, n, -p, -s) for r, (s, n) in enumerate(hard[: H.NEGATIVES])]
    return sorted(found)


def check(spark, rows, every=3, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)
    found = H.hard_negatives(df, F.col("id") % every == 0, **options)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    plain = df.select("vec_id", "embedding", "label").collect()
    expected = brute(plain, lambda i: i % every == 0)
    assert sorted(tuple(r) for r in found.collect()) == expected
    return expected


def clustered(n, width, labels=5, seed=3, noise=0.1):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.5) for _ in range(width)] for _ in range(labels)]
    rows = []
    for i in range(n):
        c = rnd.randrange(labels)
        v = [x + rnd.gauss(0, noise) for x in centres[c]]
        rows.append((i, v, c if rnd.random() < 0.8 else (c + 1) % labels))
    return rows


def test_many_blocks_and_levels(spark):
    assert check(spark, clustered(900, 6), every=9, block_rows=40)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(40, 3, labels=2) + [
        (60, None, 1),
        (63, [0.1, None], 1),
        (66, [nan, 0.1, 0.1], 1),
        (69, [inf, 0.1, 0.1], 1),
        (72, [0.1, 0.1, 0.1], None),
        (None, [0.1, 0.1, 0.1], 1),
        (75, [], 1),
        (78, [0.5], 0),
    ]
    check(spark, rows)


def test_ties_and_repeated_rows(spark):
    same = [0.5, 0.25]
    rows = [(i, same, i % 2) for i in range(30)] + [(3, same, 1), (3, same, 1), (3, same, 0)]
    assert check(spark, rows, block_rows=7)


def test_hot_vector_is_split(spark):
    rows = [(i, [0.5, 0.5], i % 3) for i in range(400)] + clustered(200, 2)
    assert check(spark, rows, every=50, block_rows=60)


def test_negative_scores_have_no_window(spark):
    rows = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.9], 2), (3, [0.0], 1), (6, [0.0], 2)]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(df, F.col("id") % 2 == 0).collect() == []


def test_too_long_vectors_fail(spark):
    df = spark.createDataFrame([(1, [1e30], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="squared length"):
        H.hard_negatives(df, F.col("id") % 2 == 0)


def index_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return H.build_index(H._kept(df, "vec_id", "embedding", "label"), **options)


def test_blocks_are_bounded_and_complete(spark):
    rows = [(i, [0.5, 0.5], 1) for i in range(1000)] + clustered(500, 2)
    index = index_of(spark, rows, block_rows=50)
    sizes = [r["count"] for r in index.rows.groupBy("block").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 60
    reachable = {first + i for first, parts in index.blocks.values() for i in range(parts)}
    assert {r["block"] for r in index.rows.select("block").distinct().collect()} <= reachable


def test_ranges_rule_out_only_what_cannot_match(spark):
    """Leaves that a window leaves out hold no row in it, and some are left out."""
    index = index_of(spark, clustered(1500, 4, labels=12, noise=0.02), block_rows=20)
    rows = index.rows.collect()
    tree, left_out = index.tree, 0
    for anchor in rows[::100]:
        v = np.array(anchor["v"])
        scores = {r["rid"]: float(v @ np.array(r["v"])) for r in rows}
        top = sorted(scores.values())[-30]
        base = (v**2).sum() + tree.radius2
        inner = np.array([math.sqrt(max(base - 2 * scores[anchor["rid"]], 0)) - tree.slack])
        outer = np.array([math.sqrt(base - 2 * top) + tree.slack])
        leaves = set(H.surviving(tree, np.append(v, 0.0), inner, outer))
        for r in rows:
            if top <= scores[r["rid"]] <= scores[anchor["rid"]]:
                assert r["leaf"] in leaves
        left_out += len(index.blocks) - len(leaves)
    assert left_out > 0.3 * len(index.blocks) * len(rows[::100])
