"""Vector codes: every vector as the nearest entries of small codebooks, one for each part.

Components are integers.  Rows are packed in batches that hold, for each dimension, the
distinct integers (a dictionary) and every row's place in it.  To find nearest entries,
the squared differences of a dictionary's integers to all entries are tabulated once; a
part's distances are then gathers from these tables and additions.  A batch has a bounded
number of rows, and so have its dictionaries and tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Rows of a packed batch; codes of its dictionaries fit 16 bits.
BATCH_ROWS = 8192
#: Rows whose distances are in memory at once.
STRIP_ROWS = 1024
#: Integers of this size and more would overflow sums of squares: they are an error.
TOO_LARGE = 1 << 24


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``: integer components."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components, by part, entry and position."""
        numbers = ",".join(map(str, self.entries.ravel().tolist()))
        return hashlib.sha256(numbers.encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component."""

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        error = F.raise_error(F.lit(f"{scale} times a component is {TOO_LARGE} or more"))
        return F.when(F.abs(scaled) < TOO_LARGE, F.floor(scaled).cast("int")).otherwise(
            error.cast("int")
        )

    return F.transform(vector, whole)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of numbers without nulls as rows of ``width``; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy()
    rows = np.zeros((len(column), width), dtype=np.int64)
    rows[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return rows


def _lists(column: pa.Array) -> pa.ListArray:
    """A column as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _packer(width: int):
    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = matrix(batch.column("v"), width)
        codes = np.empty((width, len(rows)), dtype=np.uint16)
        values, sizes = [], []
        for d in range(width):
            distinct, codes[d] = np.unique(rows[:, d], return_inverse=True)
            values.append(distinct)
            sizes.append(len(distinct))
        flat = np.concatenate(values) if values else np.empty(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                _lists(batch.column("id")),
                _lists(batch.column("label")),
                pa.array([codes.tobytes()], pa.binary()),
                pa.array([sizes], pa.list_(pa.int32())),
                _lists(pa.array(flat, pa.int64())),
            ],
            names=["ids", "labels", "codes", "sizes", "values"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                head = batch.slice(0, BATCH_ROWS - rows)
                batch = batch.slice(head.num_rows)
                waiting.append(head)
                rows += head.num_rows
                if rows == BATCH_ROWS:
                    yield pack(_joined(waiting))
                    waiting, rows = [], 0
        if rows:
            yield pack(_joined(waiting))

    return run


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def pack_rows(rows: DataFrame, width: int) -> DataFrame:
    """``rows(id, label, v)`` in batches of dictionary codes; written, as it is read often."""
    common.workers_find_package(rows.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    packed = rows.select("id", "label", "v").mapInArrow(
        _packer(width),
        f"ids array<{kind['id']}>, labels array<{kind['label']}>, codes binary, "
        "sizes array<int>, values array<bigint>",
    )
    return common.stored(packed, "packs")


def _unpack(pack: pa.RecordBatch, at: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes by dimension and row, and each dimension's dictionary."""
    values = pack.column("values")[at].values.to_numpy()
    sizes = pack.column("sizes")[at].values.to_numpy()
    codes = np.frombuffer(pack.column("codes")[at].as_py(), dtype=np.uint16)
    rows = len(pack.column("ids")[at].values)
    return codes.reshape(len(sizes), rows), np.split(values, np.cumsum(sizes)[:-1])


def nearest(
    codes: np.ndarray, dictionaries: list[np.ndarray], entries: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row in one part, the first on ties, and its distance.

    ``entries`` are those of the part, whose dimensions ``codes`` and ``dictionaries`` hold.
    """
    tables = [
        (distinct[:, None] - entries[:, d]) ** 2 for d, distinct in enumerate(dictionaries)
    ]
    if sum(int(t.max()) for t in tables) < 1 << 31:
        tables = [t.astype(np.int32) for t in tables]
    kind = tables[0].dtype if tables else np.dtype(np.int64)
    n = codes.shape[1]
    best = np.empty(n, dtype=np.int64)
    errors = np.empty(n, dtype=np.int64)
    for at in range(0, n, STRIP_ROWS):
        strip = codes[:, at : at + STRIP_ROWS]
        gaps = np.zeros((strip.shape[1], len(entries)), dtype=kind)
        for table, code in zip(tables, strip):
            gaps += table[code]
        place = gaps.argmin(axis=1)
        best[at : at + STRIP_ROWS] = place
        errors[at : at + STRIP_ROWS] = gaps[np.arange(len(place)), place]
    return best, errors


def _part(codes: np.ndarray, dictionaries: list[np.ndarray], part: int, width: int):
    own = slice(part * width, (part + 1) * width)
    return codes[own], dictionaries[own]


def _sums(entries: np.ndarray):
    """Rows ``(part, entry, n, sums)`` of a task: its rows next to each entry."""
    parts, size, width = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, size), dtype=np.int64)
        sums = np.zeros((parts, size, width), dtype=np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                codes, dictionaries = _unpack(batch, at)
                for p in range(parts):
                    own, values = _part(codes, dictionaries, p, width)
                    best, _ = nearest(own, values, entries[p])
                    counts[p] += np.bincount(best, minlength=size)
                    for d in range(width):
                        # whole numbers below 2 ** 53, so these sums are exact
                        sums[p, :, d] += np.bincount(
                            best, weights=values[d][own[d]], minlength=size
                        ).astype(np.int64)
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(part, pa.int32()),
                    "entry": pa.array(entry, pa.int32()),
                    "n": pa.array(counts[part, entry]),
                    "sums": pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
                }
            )

    return run


def train(packs: DataFrame, entries: np.ndarray, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` of assigning all rows and taking floors of the means.

    A round is one job.  A task returns a row for each entry at most, these combine in
    the shuffle, and as many rows as there are entries come to the driver.
    """
    entries = entries.copy()
    width = entries.shape[2]
    for _ in range(rounds):
        found = packs.mapInArrow(_sums(entries), "part int, entry int, n bigint, sums array<bigint>")
        totals = [F.sum(F.col("sums")[d]) for d in range(width)]
        means = found.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*totals).cast("array<bigint>").alias("sums")
        )
        for row in means.collect():
            entries[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return Codebooks(entries)


def encode(packs: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``(id, label, code, error)`` of every packed row."""
    entries = codebooks.entries
    parts, _, width = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                codes, dictionaries = _unpack(batch, at)
                places = np.empty((codes.shape[1], parts), dtype=np.uint8)
                error = np.zeros(codes.shape[1], dtype=np.int64)
                for p in range(parts):
                    best, gaps = nearest(*_part(codes, dictionaries, p, width), entries[p])
                    places[:, p] = best
                    error += gaps
                digits = places.tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[at].values,
                        batch.column("labels")[at].values,
                        pa.array([digits[i : i + step] for i in range(0, len(digits), step)]),
                        pa.array(error),
                    ],
                    names=["id", "label", "code", "error"],
                )

    kind = {f.name: f.dataType.elementType.simpleString() for f in packs.schema.fields[:2]}
    return packs.mapInArrow(
        run, f"id {kind['ids']}, label {kind['labels']}, code string, error bigint"
    )


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the sum of errors over rows with the same label; null is a label too."""
    sums = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    sums = common.stored(sums, "label_errors")
    longest = sums.agg(F.max(F.length(F.col("same").cast("string")))).first()[0] or 0
    # Beyond the limit a plain join, in which a label with very many rows is split at run time.
    sums = common.sized(sums, row_bytes=64 + 4 * longest)
    return coded.join(sums, coded["label"].eqNullSafe(sums["same"])).drop("same")


def _smallest(kept: DataFrame) -> list:
    """The ``ENTRIES`` rows with the smallest ids; ids alone are compared first."""
    ids = kept.select("id").orderBy(F.asc_nulls_last("id")).limit(ENTRIES)
    last, n = ids.agg(F.max("id"), F.count("id")).first()
    few = kept if n < ENTRIES else kept.filter(F.col("id") <= last)
    return few.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(ENTRIES).collect()


def vector_codes(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """``(id, code, error, label_error)`` of every usable vector, and the codebooks.

    Rows whose vector is null or has a null, infinite or undefined component are left
    out.  Vectors are as wide as the longest one, made a multiple of ``PARTS``; shorter
    ones, empty ones too, end in zeros.  A scaled component of ``TOO_LARGE`` or more is
    an error.  Codebooks start from the rows with the smallest ids, null ids last and
    equal ids by their vectors; with fewer rows than entries there are fewer entries.
    Repeated rows count each; further columns are left alone.  An empty table gives no
    rows and empty codebooks.
    """
    kept = df.filter(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        integers(F.col(vector_col)).alias("v"),
    )
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // PARTS))
    start = _smallest(kept)
    first = np.zeros((len(start), PARTS * width), dtype=np.int64)
    for i, row in enumerate(start):
        first[i, : len(row["v"])] = row["v"]
    entries = first.reshape(len(start), PARTS, width).transpose(1, 0, 2)
    packs = pack_rows(common.spread(kept, "id"), PARTS * width)
    codebooks = train(packs, entries)
    coded = common.stored(encode(packs, codebooks), "codes")
    found = _with_label_error(coded).select(
        F.col("id").alias(id_col), "code", "error", "label_error"
    )
    return found, codebooks
