"""Hard negatives by an exact search in a tree of split points with distance ranges.

Scores are inner products of integer vectors.  A further coordinate gives all rows the
same length, so that a window of scores is a window of distances from the anchor: an
annulus.  The tree is multiway: each node has split points, and a row goes to the child
whose point is nearest (the cells are bounded by hyperplanes).  For each pair of split
points of a node the tree keeps the range of distances from the one to the rows under the
other.  An anchor's annulus around its own distance to a split point rules out every
sibling whose range it does not meet.  All rows of the leaves that stay are scored.

Split points come from a bounded sample; ranges and leaves are of all rows.  Leaves are
packed into blocks of rows, large ones split, and anchors meet blocks in bounded groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.llm import common
from corpusflow.llm.vector_codes import usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this share of its positive, in percent, and not more than it.
LEAST_PERCENT = 80
#: Split points of a node, the most levels of nodes, and about how many rows points come from.
FAN_OUT = 16
MAX_LEVELS = 3
SAMPLE_ROWS = 16384
#: Rows of a block, anchors that meet a block at once, rows scored at once.
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 4096
STRIP_ROWS = 512
#: Distances are floating-point; what is this close (relatively) is never ruled out.
SLACK = 1e-6
#: Squared lengths below this keep all inner products exact as doubles; others are an error.
TOO_LONG = float(1 << 53)


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component, as whole doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of numbers without nulls as rows of ``width``; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy()
    rows = np.zeros((len(column), width))
    rows[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return rows


# --- the tree ----------------------------------------------------------------


@dataclass
class Node:
    """Split points, and the subtree or leaf of each; children are node or leaf numbers."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)
    leaf: bool = True


@dataclass
class Tree:
    """Nodes by number, the root first.  ``radius2``: the squared length of all rows.

    ``ranges[node][i, j]``: smallest and largest distance from split point ``i`` to the
    rows under split point ``j``.
    """

    nodes: list[Node]
    width: int
    radius2: float
    leaves: int
    ranges: dict[int, np.ndarray] = field(default_factory=dict)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        """Rows with the coordinate that makes them equally long."""
        rest = np.maximum(self.radius2 - (rows**2).sum(axis=1), 0.0)
        return np.column_stack([rows, np.sqrt(rest)])

    @property
    def slack(self) -> float:
        return SLACK * (1.0 + math.sqrt(self.radius2))


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1) - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0.0))


def _spread_points(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows, each the farthest from those before it."""
    chosen = [rows[0]]
    gap = distances(rows, rows[:1])[:, 0]
    while len(chosen) < n and gap.max() > 0:
        at = int(gap.argmax())
        chosen.append(rows[at])
        gap = np.minimum(gap, distances(rows, rows[at : at + 1])[:, 0])
        gap[at] = 0.0
    return np.array(chosen)


def build_tree(sample: np.ndarray, radius2: float, levels: int, fan_out: int = FAN_OUT) -> Tree:
    """Split points of every node, from the rows of a sample."""
    tree = Tree([], sample.shape[1], radius2, 0)

    def grow(rows: np.ndarray, level: int) -> int:
        number = len(tree.nodes)
        node = Node(_spread_points(rows, fan_out), leaf=level + 1 >= levels)
        tree.nodes.append(node)
        if node.leaf:
            node.children = list(range(tree.leaves, tree.leaves + len(node.points)))
            tree.leaves += len(node.points)
        else:
            nearest = distances(rows, node.points).argmin(axis=1)
            for j, point in enumerate(node.points):
                own = rows[nearest == j]
                node.children.append(grow(own if len(own) else point[None], level + 1))
        return number

    if len(sample):
        grow(tree.lifted(sample), 0)
    return tree


def descend(tree: Tree, rows: np.ndarray, met=None) -> np.ndarray:
    """The leaf of every lifted row; ``met(node, gaps, nearest)`` sees all nodes passed."""
    leaf = np.zeros(len(rows), dtype=np.int64)
    todo = [(0, np.arange(len(rows)))]
    while todo:
        number, own = todo.pop()
        if not len(own):
            continue
        node = tree.nodes[number]
        gaps = distances(rows[own], node.points)
        nearest = gaps.argmin(axis=1)
        if met is not None:
            met(number, gaps, nearest)
        for j, child in enumerate(node.children):
            if node.leaf:
                leaf[own[nearest == j]] = child
            else:
                todo.append((child, own[nearest == j]))
    return leaf


def surviving(tree: Tree, point: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> list[int]:
    """Leaves that may hold rows at distances ``inner`` to ``outer`` from ``point``.

    Several windows may be given; a leaf stays if one of them may meet it.
    """
    found: list[int] = []
    todo = [(0, np.ones(len(inner), dtype=bool))]
    while todo:
        number, open_ = todo.pop()
        node, low, high = tree.nodes[number], *np.moveaxis(tree.ranges[number], 2, 0)
        own = distances(point[None], node.points)[0]
        # rows of the annulus lie between these distances from each split point
        least = np.maximum(np.maximum(own[:, None] - outer, inner - own[:, None]), 0.0)
        most = own[:, None] + outer
        for j, child in enumerate(node.children):
            meets = (least <= high[:, j, None]) & (most >= low[:, j, None])
            stays = open_ & meets.all(axis=0)
            if not stays.any():
                continue
            if node.leaf:
                found.append(child)
            else:
                todo.append((child, stays))
    return sorted(found)


# --- rows, leaves and blocks ---------------------------------------------------


@dataclass
class Index:
    """All rows with their leaf, and the blocks that leaves are packed into."""

    rows: DataFrame  # rid, id, label, v, leaf, block
    tree: Tree
    #: Of every leaf, its first block and into how many it is split.
    blocks: dict[int, tuple[int, int]]


def _kept(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    fine = usable(F.col(vector_col)) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    return df.filter(fine).select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        integers(F.col(vector_col)).alias("v"),
    )


def _ranges(rows: DataFrame, tree: Tree) -> DataFrame:
    """``(node, i, j, low, high, n)``; a task returns a row for each pair of points at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def met(number: int, gaps: np.ndarray, nearest: np.ndarray) -> None:
            m = gaps.shape[1]
            if number not in seen:
                empty = np.full((m, m), np.inf)
                seen[number] = (empty, -empty, np.zeros(m, dtype=np.int64))
            low, high, n = seen[number]
            for j in np.unique(nearest):
                own = gaps[nearest == j]
                low[:, j] = np.minimum(low[:, j], own.min(axis=0))
                high[:, j] = np.maximum(high[:, j], own.max(axis=0))
                n[j] += len(own)

        for batch in batches:
            descend(tree, tree.lifted(matrix(batch.column("v"), tree.width)), met)
        for number, (low, high, n) in seen.items():
            i, j = np.nonzero(np.isfinite(low))
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array(np.full(len(i), number), pa.int32()),
                    "i": pa.array(i, pa.int32()),
                    "j": pa.array(j, pa.int32()),
                    "low": low[i, j],
                    "high": high[i, j],
                    "n": n[j],
                }
            )

    found = rows.select("v").mapInArrow(
        run, "node int, i int, j int, low double, high double, n bigint"
    )
    return found.groupBy("node", "i", "j").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
    )


def _with_ranges(tree: Tree, rows: DataFrame) -> dict[int, int]:
    """Fills in the tree's ranges; returns the rows of each leaf.

    As many rows come to the driver as the tree has pairs of points in its nodes, which
    the sample bounds.
    """
    for number, node in enumerate(tree.nodes):
        m = len(node.points)
        tree.ranges[number] = np.stack([np.full((m, m), np.inf), np.full((m, m), -np.inf)], axis=2)
    sizes: dict[int, int] = {}
    for r in _ranges(rows, tree).collect():
        node = tree.nodes[r["node"]]
        tree.ranges[r["node"]][r["i"], r["j"]] = r["low"] - tree.slack, r["high"] + tree.slack
        if node.leaf and r["i"] == 0:
            sizes[node.children[r["j"]]] = r["n"]
    return sizes


def _blocks(sizes: dict[int, int], block_rows: int) -> dict[int, tuple[int, int]]:
    """Leaves in order: small ones share a block, large ones have several."""
    blocks, number, filled = {}, 0, 0
    for leaf in sorted(sizes):
        if filled and filled + sizes[leaf] > block_rows:
            number, filled = number + 1, 0
        parts = math.ceil(sizes[leaf] / block_rows)
        blocks[leaf] = (number, parts)
        number, filled = (number, filled + sizes[leaf]) if parts == 1 else (number + parts, 0)
    return blocks


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Index:
    """The tree over ``rows(id, label, v)``, and all rows with their leaf and block."""
    spark = rows.sparkSession
    common.workers_find_package(spark)
    numbered = rows.withColumn("rid", F.monotonically_increasing_id())
    rows = common.stored(numbered, "vectors")
    length2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, width, radius2 = rows.agg(F.count("*"), F.max(F.size("v")), F.max(length2)).first()
    if n and radius2 >= TOO_LONG:
        raise ValueError(f"a vector's squared length is {radius2}, limit {TOO_LONG}")
    levels = min(MAX_LEVELS, max(1, math.ceil(math.log(max(n / block_rows, 1), FAN_OUT)) + 1))
    # Split points only: the sample is bounded, and every row is indexed below.
    share = F.lit(int(min(1.0, SAMPLE_ROWS / max(n, 1)) * (1 << 31)))
    picked = rows.filter(F.pmod(F.xxhash64("rid"), F.lit(1 << 31)) < share).select("v").toArrow()
    sample = matrix(picked.column("v").combine_chunks(), width or 0)
    tree = build_tree(sample, radius2 or 0.0, levels)
    blocks = _blocks(_with_ranges(tree, rows), block_rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.array([blocks.get(leaf, (0, 1)) for leaf in range(tree.leaves)])
        for batch in batches:
            leaf = descend(tree, tree.lifted(matrix(batch.column("v"), tree.width)))
            start, parts = first[leaf].T
            block = start + batch.column("rid").to_numpy() % parts
            batch = batch.append_column("leaf", pa.array(leaf, pa.int32()))
            yield batch.append_column("block", pa.array(block, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = rows.mapInArrow(place, schema + ", leaf int, block bigint")
    return Index(common.stored(placed, "leaves"), tree, blocks)


# --- search --------------------------------------------------------------------


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest scores by anchor and window; missing windows hold no score."""
    low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
    n = max(map(len, low), default=0)
    return (
        np.array([w + [math.inf] * (n - len(w)) for w in low]).reshape(len(low), n),
        np.array([w + [-math.inf] * (n - len(w)) for w in high]).reshape(len(high), n),
    )


def _visits(index: Index, anchors: DataFrame, home: bool) -> DataFrame:
    """``anchors(aid, label, v, low, high)`` with each ``block`` and its ``leaves`` to score.

    ``home``: only the leaf that the anchor itself is in.  Otherwise all leaves that one
    of its annuli may meet.
    """
    tree, blocks = index.tree, index.blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("v"), tree.width)
            points = np.column_stack([vectors, np.zeros(len(vectors))])
            own = descend(tree, tree.lifted(vectors))
            low, high = _windows(batch)
            # squared distance to a row = |anchor|^2 + radius2 - 2 score
            base = (vectors**2).sum(axis=1)[:, None] + tree.radius2
            inner = np.sqrt(np.maximum(base - 2 * high, 0.0)) - tree.slack
            outer = np.sqrt(np.maximum(base - 2 * low, 0.0)) + tree.slack
            take, numbers, lists = [], [], []
            for at in range(len(vectors)):
                full = low[at] <= high[at]
                leaves = [int(own[at])]
                if not home:
                    leaves = surviving(tree, points[at], inner[at][full], outer[at][full])
                met: dict[int, list[int]] = {}
                for leaf in leaves:
                    first, parts = blocks.get(leaf, (0, 0))
                    for number in range(first, first + parts):
                        met.setdefault(number, []).append(leaf)
                take += [at] * len(met)
                numbers += met.keys()
                lists += met.values()
            out = batch.take(pa.array(take, pa.int64()))
            out = out.append_column("block", pa.array(numbers, pa.int64()))
            yield out.append_column("leaves", pa.array(lists, pa.list_(pa.int32())))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, schema + ", block bigint, leaves array<int>")


def _first(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first ``k`` rows of each anchor and window."""
    ranked = found.sort_values(
        ["aid", "win", "score", "id"], ascending=[True, True, False, True], kind="stable"
    )
    return ranked[ranked.groupby(["aid", "win"]).cumcount() < k]


def _scan_rows(visits: pa.RecordBatch, rows: pa.RecordBatch, same_label: bool, k: int, width: int):
    """The first ``k`` rows of each anchor and window among the rows of one block."""
    anchors, vectors = matrix(visits.column("v"), width), matrix(rows.column("v"), width)
    aids, rids = visits.column("aid").to_numpy(), rows.column("rid").to_numpy()
    labels = visits.column("label").to_pandas().to_numpy()
    row_labels = rows.column("label").to_pandas().to_numpy()
    ids, leaves = rows.column("id").to_pandas().to_numpy(), rows.column("leaf").to_numpy()
    low, high = _windows(visits)
    wanted = np.zeros((len(aids), int(leaves.max()) + 1), dtype=bool)
    for at, mine in enumerate(visits.column("leaves").to_pylist()):
        wanted[at, [leaf for leaf in mine if leaf < wanted.shape[1]]] = True
    place = pd.Series(np.arange(len(aids)), index=aids)
    best = None
    for at in range(0, len(rids), STRIP_ROWS):
        strip = slice(at, at + STRIP_ROWS)
        scores = anchors @ vectors[strip].T
        fits = ((labels[:, None] == row_labels[strip]) == same_label) & wanted[:, leaves[strip]]
        fits &= aids[:, None] != rids[strip]
        found = [] if best is None else [best]
        for w in range(low.shape[1]):
            q, r = np.nonzero(fits & (scores >= low[:, w, None]) & (scores <= high[:, w, None]))
            hits = {"aid": aids[q], "win": w, "score": scores[q, r], "id": ids[strip][r]}
            if len(q):
                found.append(pd.DataFrame(hits))
        if len(found) > (best is not None):
            best = _first(pd.concat(found), k)
            # what is below the k-th score so far no longer counts
            kth = best.groupby(["aid", "win"])["score"].agg(["size", "min"]).reset_index()
            kth = kth[kth["size"] == k]
            low[place[kth["aid"]].to_numpy(), kth["win"].to_numpy()] = kth["min"]
    return best


def _scan(same_label: bool, k: int, width: int):
    def run(visits: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema(
            [
                ("aid", pa.int64()),
                ("win", pa.int32()),
                ("score", pa.int64()),
                ("id", rows.schema.field("id").type),
            ]
        )
        best = None
        if visits.num_rows and rows.num_rows:
            rows = rows.sort_by([("leaf", "ascending"), ("id", "ascending")])
            one = [t.combine_chunks().to_batches()[0] for t in (visits, rows)]
            best = _scan_rows(*one, same_label, k, width)
        if best is None:
            return schema.empty_table()
        return pa.Table.from_pandas(best, schema=schema, preserve_index=False)

    return run


def search(
    index: Index, anchors: DataFrame, same_label: bool, k: int, home: bool = False
) -> DataFrame:
    """``(aid, win, score, id, rank)``: the first ``k`` rows in each window of each anchor.

    ``anchors`` are rows of the index as ``(aid, label, v)`` with arrays ``low`` and
    ``high``, one entry a window.  Only rows of the same label count, or only others, and
    never the anchor itself.  Higher scores come first, then smaller ids.
    """
    visits = common.stored(_visits(index, anchors, home), "visits")
    met = visits.groupBy("block").agg(F.count("*").alias("n"))
    groups = F.ceil(F.col("n") / BLOCK_ANCHORS).cast("int")
    met = common.stored(met.select("block", groups.alias("groups")), "met")
    met = common.sized(met, row_bytes=64)
    left = visits.join(met, "block").withColumn(
        "part", F.pmod(F.xxhash64("aid"), F.col("groups")).cast("int")
    ).drop("groups")
    right = index.rows.join(met, "block").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    ).drop("groups")
    kind = index.rows.schema["id"].dataType.simpleString()
    found = (
        left.groupBy("block", "part")
        .cogroup(right.groupBy("block", "part"))
        .applyInArrow(
            _scan(same_label, k, index.tree.width),
            f"aid bigint, win int, score bigint, id {kind}",
        )
    )
    order = Window.partitionBy("aid", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors``: a condition on ``id``.  Rows with a null id, label or vector, or a null,
    infinite or undefined component, take no part.  An anchor's positives are the first
    ``POSITIVES`` other rows of its label; for each, the first ``NEGATIVES`` rows of other
    labels with ``LEAST_PERCENT`` to 100 percent of the positive's score are returned.  Rows
    that repeat an id are rows of their own, also as anchors, and ties beyond the id are
    alike in all columns returned.  Shorter vectors end in zeros.  Further columns are
    left alone; an empty table gives no rows.
    """
    index = build_index(_kept(df, id_col, vector_col, label_col), block_rows)
    own = index.rows.filter(anchors).select(F.col("rid").alias("aid"), "id", "label", "v")
    own = common.stored(own, "anchors")
    query = own.select("aid", "label", "v")
    least, most = F.lit(float("-inf")), F.lit(float("inf"))

    # The anchor's own leaf gives a bound for its positives everywhere.
    everything = query.withColumns({"low": F.array(least), "high": F.array(most)})
    near = search(index, everything, True, POSITIVES, home=True)
    bound = near.filter(F.col("rank") == POSITIVES).select(
        F.col("aid").alias("of"), F.col("score").cast("double").alias("bound")
    )
    bounded = query.join(bound, query["aid"] == bound["of"], "left").select(
        *query.columns, F.array(F.coalesce("bound", least)).alias("low"), F.array(most).alias("high")
    )
    found = search(index, bounded, True, POSITIVES)
    positives = common.stored(found.select("aid", "rank", "id", "score"), "positives")

    # A window for each positive, in the order of their ranks: the scores s with
    # 80 p <= 100 s <= 100 p, for whole s.  It is empty for p below zero.
    least_score = f"cast((cast(p.score as decimal(20)) * {LEAST_PERCENT} + 99) div 100 as double)"
    lists = positives.groupBy(F.col("aid").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("all")
    )
    windows = query.join(lists, query["aid"] == lists["of"]).select(
        *query.columns,
        F.expr(f"transform(all, p -> {least_score})").alias("low"),
        F.transform("all", lambda p: p["score"].cast("double")).alias("high"),
    )
    found = search(index, windows, False, NEGATIVES)
    negatives = found.select(
        F.col("aid").alias("of"),
        (F.col("win") + 1).alias("nth"),
        F.col("rank").alias("place"),
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    mined = negatives.join(
        positives, (negatives["of"] == positives["aid"]) & (negatives["nth"] == positives["rank"])
    ).drop("of", "nth", "rank")
    named = own.select(F.col("aid").alias("of"), F.col("id").alias("anchor_id"))
    return mined.join(named, mined["aid"] == named["of"]).select(
        "anchor_id",
        F.col("id").alias("positive_id"),
        F.col("place").alias("rank"),
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )
