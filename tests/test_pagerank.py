"""Ranks of many graphs at once against one graph at a time in plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import graph, pagerank


def plain_edges(sets):
    found = {}
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            shared = len(set(a) & set(sets[j]))
            weight = shared / max(len(a) + len(sets[j]) - shared, 1)
            if weight > pagerank.MIN_SIMILARITY:
                found[i, j] = weight
    return found


def plain_ranks(n, edges):
    near = [{} for _ in range(n)]
    for (i, j), weight in edges.items():
        near[i][j] = near[j][i] = weight
    strength = [sum(links.values()) for links in near]
    x = [1.0 / n] * n
    for _ in range(pagerank.MAX_ROUNDS if edges else 0):
        spread = sum(x[i] for i in range(n) if not near[i])
        base = (1 - pagerank.DAMPING + pagerank.DAMPING * spread) / n
        flow = [sum(x[j] * w / strength[j] for j, w in links.items()) for links in near]
        x, before = [base + pagerank.DAMPING * f for f in flow], x
        if sum(abs(p - q) for p, q in zip(x, before)) < n * pagerank.TOLERANCE:
            break
    return x


def some_sets(seed, graphs=60):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(25)]
    sizes = [0, 1, 2, *rng.integers(0, 30, graphs)]
    return [
        [rng.choice(words, rng.integers(0, 9), replace=False).tolist() for _ in range(n)]
        for n in sizes
    ]


@pytest.mark.parametrize("pairs", [1, 700, pagerank.PAIRS])
def test_ranks_of_a_batch_are_those_of_each_graph(monkeypatch, pairs):
    monkeypatch.setattr(pagerank, "PAIRS", pairs)
    graphs = some_sets(7)
    sizes = np.array([len(g) for g in graphs])
    tokens = np.array([len(t) for g in graphs for t in g])
    codes = np.array([int(t[1:]) for g in graphs for ts in g for t in ts])
    src, dst, weight = pagerank.edges(sizes, tokens, codes)
    every = {(int(i), int(j)): w for i, j, w in zip(src, dst, weight)}
    first = np.cumsum(sizes) - sizes
    ranks = pagerank.ranks(sizes, src, dst, weight)
    assert len(ranks) == sizes.sum()
    for at, sets in zip(first.tolist(), graphs):
        mine = plain_edges(sets)
        assert {(at + i, at + j): w for (i, j), w in mine.items()}.items() <= every.items()
        for pair in mine:
            del every[at + pair[0], at + pair[1]]
        assert ranks[at : at + len(sets)] == pytest.approx(plain_ranks(len(sets), mine) if sets else [])
    assert not every


def test_ranks_as_columns(spark):
    graphs = some_sets(8)
    rows = [(i, g, len(g), [(*p, w) for p, w in reversed(plain_edges(g).items())]) for i, g in enumerate(graphs)]
    schema = "i int, sets array<array<string>>, n int, e array<struct<src:int,dst:int,weight:double>>"
    df = spark.createDataFrame([*rows, (999, None, None, None), (1000, [["a"], ["b"]], 2, None)], schema)
    found = df.select(
        "i",
        pagerank.ranks_of_sets(F.col("sets")).alias("a"),
        pagerank.ranks_of_edges(F.col("n"), F.col("e")).alias("b"),
    )
    by_row = {r["i"]: r for r in found.repartition(3).collect()}
    assert by_row[999]["a"] is None and by_row[999]["b"] is None
    assert by_row[1000]["a"] == by_row[1000]["b"] == [0.5, 0.5]
    for i, sets in enumerate(graphs):
        wanted = plain_ranks(len(sets), plain_edges(sets)) if len(sets) > 1 else None
        for name in "ab":
            assert by_row[i][name] == (wanted and pytest.approx(wanted))


def test_the_join_looks_at_sentences_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<array<string>>")
    def sets(i):
        calls.add(1)
        return [["a", "b", f"c{i}"], ["a", "b"], ["b", "d"]]

    nodes = spark.range(0, 20, 1, 2).select(F.col("id").alias("ID"), sets("id").alias("sets"))
    edges = graph.joined_edges(nodes, "ID")
    assert edges.count() == 60 and len(edges.collect()) == 60
    assert calls.value == 20
