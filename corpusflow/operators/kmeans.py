"""K-Means whose restarts, for all wanted numbers of clusters, advance together.

A round is one pass over the points for all runs that still move: a task assigns its
points to the centres of every run and returns a count and a vector sum for each centre,
which are added up.  Fifty restarts cost the jobs of the longest one, and only
centres and costs are on the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusflow.sources import workers

MAX_ROUNDS = 1000
#: A run ends when none of its centres moves farther than this.
TOLERANCE = 1e-4
#: Points of a pack, and how many of them meet all centres at once: few, as the distances
#: then stay in a core's cache.
PACK, TILE = 4096, 256
#: Up to so many tasks send their sums to the driver; the sums of more meet in tasks first.
DIRECT = 32


@dataclass
class Run:
    """One restart: its centres as rows, and the sum of squared distances to them."""

    k: int
    seed: int
    centres: np.ndarray
    cost: float = np.inf


def _uniform(row: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in (0, 1] for each row, the same wherever and whenever it is worked on."""
    mixed = np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xBF58476D1CE4E5B9) % (1 << 64))
    z = row.astype(np.uint64) ^ mixed
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 1.0) / float(1 << 53)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    lengths = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)
    return np.maximum(lengths - 2 * points @ centres.T, 0.0)


def _packed(points: DataFrame) -> RDD:
    """``points(row, v)`` as packs of arrays ``(vectors, rows)``.

    An RDD: a round is one small job, which needs no plan of its own.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PACK):
                part = batch.iloc[at : at + PACK]
                vectors = np.array(part["v"].tolist(), dtype=float)
                rows = part["row"].to_numpy(dtype=np.int64)
                packed = (len(part), vectors.tobytes(), rows.tobytes())
                yield pd.DataFrame([packed], columns=["n", "vectors", "rows"])

    def unpack(row: Row) -> tuple[np.ndarray, np.ndarray]:
        vectors = np.frombuffer(row["vectors"]).reshape(row["n"], -1)
        return vectors, np.frombuffer(row["rows"], dtype=np.int64)

    return points.mapInPandas(pack, "n int, vectors binary, rows binary").rdd.map(unpack)


def _tiles(packs: Iterable[tuple]) -> Iterator[tuple]:
    """The same arrays in runs of at most ``TILE`` points."""
    for pack in packs:
        for at in range(0, len(pack[0]), TILE):
            yield tuple(array[at : at + TILE] for array in pack)


def _merged(parts: RDD, merge: Callable):
    """What the tasks found, put together; beyond ``DIRECT`` tasks not by the driver alone."""
    return parts.treeReduce(merge, depth=1 if parts.getNumPartitions() <= DIRECT else 2)


def _first_centres(points: RDD, runs: list[Run]) -> None:
    """Chooses the centres of all runs by k-means++, one for each run in a pass.

    A point is drawn with a chance in proportion to its squared distance from the centres
    so far: of exponential waiting times with these rates the shortest wins.
    """
    for step in range(max(run.k for run in runs)):
        open_ = [(i, run) for i, run in enumerate(runs) if len(run.centres) == step < run.k]
        if not open_:
            break
        centres = np.vstack([run.centres for _, run in open_]) if step else None
        seeds = [(i, run.seed) for i, run in open_]

        def draw(packs: Iterator) -> Iterator[dict[int, tuple[float, list[float]]]]:
            best: dict[int, tuple[float, list[float]]] = {}
            for v, row in _tiles(packs):
                if step:
                    weights = _squares(v, centres).reshape(len(v), -1, step).min(axis=2)
                for place, (i, seed) in enumerate(seeds):
                    weight = weights[:, place] if step else np.ones(len(v))
                    with np.errstate(divide="ignore"):
                        wait = -np.log(_uniform(row, seed, step)) / weight
                    wait[weight <= 0] = np.inf
                    at = int(wait.argmin())
                    if wait[at] < best.get(i, (np.inf,))[0]:
                        best[i] = float(wait[at]), v[at].tolist()
            yield best

        def sooner(one: dict, other: dict) -> dict:
            # Equal waiting times: the smaller vector.
            return one | {i: min(one.get(i, found), found) for i, found in other.items()}

        for i, (_, v) in _merged(points.mapPartitions(draw), sooner).items():
            centre = np.array([v])
            runs[i].centres = np.vstack([runs[i].centres, centre]) if step else centre


def _sums(
    packs: Iterable[tuple], centres: np.ndarray, blocks: Sequence[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points and vector sums of each centre, and the cost of each run.

    ``blocks`` are ``(size, count)``: so many neighbouring runs with as many centres.  Each
    run gives a point to its nearest centre, the first one on ties.
    """
    counts, totals = np.zeros(len(centres)), np.zeros(centres.shape)
    costs = np.zeros(sum(count for _, count in blocks))
    lengths = (centres**2).sum(axis=1)[:, None]
    for v, *_ in _tiles(packs):
        own = (v**2).sum(axis=1)
        counted = np.column_stack([v, np.ones(len(v))])
        a = first = 0
        for size, count in blocks:
            b = a + size * count
            gaps = own + lengths[a:b]
            gaps -= 2 * (centres[a:b] @ v.T)
            np.maximum(gaps, 0.0, out=gaps)
            near = gaps.reshape(count, size, len(v))
            least = near.min(axis=1)
            costs[first : first + count] += least.sum(axis=1)
            mine = near == least[:, None]
            taken = mine[:, 0].copy()
            for place in range(1, size):
                mine[:, place] &= ~taken
                taken |= mine[:, place]
            sums = mine.reshape(b - a, len(v)).astype(float) @ counted
            totals[a:b] += sums[:, :-1]
            counts[a:b] += sums[:, -1]
            a, first = b, first + count
    return counts, totals, costs


def _pass(points: RDD, runs: list[Run]) -> list[tuple[np.ndarray, float, float]]:
    """New centres, cost and the farthest move of each run."""
    centres = np.vstack([run.centres for run in runs])
    starts = np.cumsum([0, *(len(run.centres) for run in runs)])
    # Neighbouring runs of as many centres are worked on as one block.
    groups = itertools.groupby(len(run.centres) for run in runs)
    blocks = [(size, len(list(group))) for size, group in groups]

    def sums(packs: Iterator) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        yield _sums(packs, centres, blocks)

    def add(one: tuple, other: tuple) -> tuple:
        return tuple(x + y for x, y in zip(one, other))

    counts, totals, costs = _merged(points.mapPartitions(sums), add)
    met = counts > 0
    moved = centres.copy()
    moved[met] = totals[met] / counts[met, None]
    steps = np.sqrt(((moved - centres) ** 2).sum(axis=1))
    return [
        (moved[a:b], float(cost), float(steps[a:b].max()))
        for a, b, cost in zip(starts[:-1], starts[1:], costs)
    ]


def fit(
    df: DataFrame, k_values: Sequence[int], restarts: int, seed: int, features: str, key: str
) -> dict[int, Run]:
    """The run of the least cost for each k; none for an empty frame.

    A run has fewer centres than ``k`` if there are fewer different points.
    """
    workers.find_package(df.sparkSession)
    rows = df.select(F.xxhash64(key).alias("row"), vector_to_array(features).alias("v"))
    points = _packed(rows).persist(StorageLevel.MEMORY_AND_DISK)  # read in every pass
    runs = [
        Run(k, seed + number, np.empty((0, 0))) for k in k_values for number in range(restarts)
    ]
    try:
        _first_centres(points, runs)
        moving = [run for run in runs if len(run.centres)]
        for _ in range(MAX_ROUNDS):
            if not moving:
                break
            found = _pass(points, moving)
            for run, (centres, _, _) in zip(moving, found):
                run.centres = centres
            moving = [run for run, (*_, step) in zip(moving, found) if step > TOLERANCE]
        ended = [run for run in runs if len(run.centres)]
        if ended:
            for run, (_, cost, _) in zip(ended, _pass(points, ended)):
                run.cost = cost
    finally:
        points.unpersist()
    best: dict[int, Run] = {}
    for run in ended:
        if run.k not in best or run.cost < best[run.k].cost:
            best[run.k] = run
    return best


def nearest(vector: Column, runs: Sequence[Run]) -> Column:
    """The number of the nearest centre in each run: ``array<int>``."""

    @F.pandas_udf("array<int>")
    def labels(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in vectors:
            points = np.array(batch.tolist(), dtype=float).reshape(len(batch), -1)
            found = np.array([_squares(points, run.centres).argmin(axis=1) for run in runs])
            yield pd.Series(list(found.T.astype(np.int32)), dtype=object)

    return labels(vector)
