"""Weighted PageRank of many small graphs at once, inside a task.

A batch of graphs is one set of arrays: nodes are numbered through, and an edge's ends
are such numbers.  Sums run in the order of the nodes, so a graph's ranks do not depend
on the others in its batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: graph and ranking rules ---------------------------------
MIN_SIMILARITY = 0.1  # an edge needs strictly more
DAMPING = 0.85
TOLERANCE = 1.0e-6  # per node, on the L1 change of one round
MAX_ROUNDS = 100
# ---------------------------------------------------------------------------

#: Pairs of sentences that are in memory at once, beyond those of one graph or sentence.
PAIRS = 1 << 19


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def cuts(work: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours with at most ``most`` work together, or one with more."""
    ends = np.cumsum(work)
    start = 0
    while start < len(work):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, end
        start = end


def edges(sizes: np.ndarray, tokens: np.ndarray, codes: np.ndarray) -> tuple:
    """``(src, dst, weight)`` of graphs with ``sizes`` nodes, each edge once.

    Node ``i`` has ``tokens[i]`` different tokens, whose numbers are in ``codes``.  The
    nodes of a graph that share a token meet as pairs; each pair has a counter.
    """
    n = int(sizes.sum())
    first = np.cumsum(sizes) - sizes  # of each graph
    graph = np.repeat(np.arange(len(sizes)), sizes)
    node = np.repeat(np.arange(n), tokens)
    key = graph[node] * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    node, key = node[order], key[order]
    last = np.flatnonzero(np.append(key[1:] != key[:-1], len(key) > 0))
    runs = np.diff(last, prepend=-1)
    later = np.repeat(last, runs) - np.arange(len(key))  # nodes behind with this token
    cells = np.cumsum(sizes**2) - sizes**2
    row = cells[graph] + (np.arange(n) - first[graph]) * sizes[graph] - first[graph]
    shared = np.zeros(int((sizes**2).sum()), np.int64)
    for a, b in cuts(later, PAIRS):
        many = later[a:b]
        if many.any():
            behind = node[ragged(np.arange(a, b) + 1, many)]
            shared += np.bincount(np.repeat(row[node[a:b]], many) + behind, minlength=len(shared))
    met = np.flatnonzero(shared)
    of = np.searchsorted(cells, met, "right") - 1
    src, dst = (first[of] + place for place in np.divmod(met - cells[of], sizes[of]))
    shared = shared[met]
    weight = shared / (tokens[src] + tokens[dst] - shared)
    near = weight > MIN_SIMILARITY
    return src[near], dst[near], weight[near]


def ranks(sizes: np.ndarray, src: np.ndarray, dst: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The rank of each node; edges have equal weight both ways.

    Nodes without neighbours pass their rank on evenly.  A graph's rounds stop when the
    L1 change is below ``TOLERANCE`` per node; without any edge its ranks are equal.
    """
    n = int(sizes.sum())
    graph = np.repeat(np.arange(len(sizes)), sizes)
    node, other = np.concatenate([src, dst]), np.concatenate([dst, src])
    order = np.argsort(node * n + other)
    node, other, weight = node[order], other[order], np.concatenate([weight, weight])[order]
    strength = np.bincount(node, weight, n)
    share = weight / strength[other]
    alone = np.flatnonzero(strength == 0)
    lonely = np.bincount(graph[alone], minlength=len(sizes))
    # All nodes without neighbours start equal and stay equal: one stands for all.
    example = np.zeros(len(sizes), np.int64)
    example[graph[alone]] = alone
    x = (1.0 / np.maximum(sizes, 1))[graph]
    moving = np.bincount(graph[node], minlength=len(sizes)) > 0
    for done in range(MAX_ROUNDS):
        if done:
            change = np.bincount(graph, np.abs(x - before), len(sizes))
            ended = moving & (change < sizes * TOLERANCE)
            if ended.any():
                moving &= ~ended
                stays = moving[graph[node]]
                node, other, share = node[stays], other[stays], share[stays]
        if not moving.any():
            break
        passed = np.where(lonely > 0, x[example] * lonely, 0.0) if n else lonely
        base = ((1.0 - DAMPING) + passed * DAMPING) / np.maximum(sizes, 1)
        flow = np.bincount(node, x[other] * share, n)
        x, before = np.where(moving[graph], base[graph] + DAMPING * flow, x), x
    return x


def _lists(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths of the lists, null ones as empty, and what is in them."""
    lengths = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)
    return lengths.astype(np.int64), array.flatten()


def _ranked(sizes: np.ndarray, found: np.ndarray) -> pa.Array:
    """Ranks as lists; null for fewer than two nodes."""
    ends = np.cumsum([0, *sizes])
    few = pa.array(sizes < 2)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found), mask=few)


def ranks_of_sets(sets: Column) -> Column:
    """Ranks of the sentences whose token sets are given: ``array<double>``.

    Null for fewer than two sentences.
    """

    @F.arrow_udf("array<double>")
    def rank(batch: pa.Array) -> pa.Array:
        sizes, nodes = _lists(batch)
        tokens, words = _lists(nodes)
        codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        starts = np.cumsum([0, *sizes])
        places = np.cumsum([0, *tokens])
        found = [np.zeros(0)]
        for a, b in cuts(sizes**2, PAIRS):
            i, j = int(starts[a]), int(starts[b])
            near = edges(sizes[a:b], tokens[i:j], codes[places[i] : places[j]])
            found.append(ranks(sizes[a:b], *near))
        return _ranked(sizes, np.concatenate(found))

    return rank(sets)


def ranks_of_edges(n: Column, found: Column) -> Column:
    """Ranks of graphs with ``n`` nodes from ``array<struct<src, dst, weight>>``, or null.

    Null edges are none; the ranks are null for fewer than two nodes.
    """

    @F.arrow_udf("array<double>")
    def rank(n: pa.Array, lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(n, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        counts, flat = _lists(lists)
        src, dst, weight = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        places = np.cumsum([0, *counts])
        found = [np.zeros(0)]
        for a, b in cuts(sizes + counts, PAIRS):
            part = slice(places[a], places[b])
            first = np.repeat(np.cumsum(sizes[a:b]) - sizes[a:b], counts[a:b])
            found.append(ranks(sizes[a:b], first + src[part], first + dst[part], weight[part]))
        return _ranked(sizes, np.concatenate(found))

    return rank(n, found)
