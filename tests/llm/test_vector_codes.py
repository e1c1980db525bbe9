"""Vector codes against plain loops."""

import math
import random

import pytest

from corpusflow.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, id int, v int"


def brute(rows):
    """Codes, errors, label errors and codebooks of ``(vec_id, vector, label)``."""
    fine = [
        r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    width = max(1, -(-max((len(r[1]) for r in fine), default=0) // V.PARTS))
    vectors = [
        [math.floor(V.SCALE * x) for x in r[1]] + [0] * (V.PARTS * width - len(r[1])) for r in fine
    ]
    order = sorted(
        range(len(fine)),
        key=lambda i: (fine[i][0] is None, fine[i][0] or 0, vectors[i][: len(fine[i][1])]),
    )
    books = [
        [vectors[i][p * width : (p + 1) * width] for i in order[: V.ENTRIES]]
        for p in range(V.PARTS)
    ]

    def assign():
        result = []
        for v in vectors:
            own = []
            for p, book in enumerate(books):
                x = v[p * width : (p + 1) * width]
                own.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book)))
            result.append(own)
        return result

    for _ in range(V.ROUNDS):
        near = assign()
        for p, book in enumerate(books):
            for i in range(len(book)):
                own = [v[p * width : (p + 1) * width] for v, n in zip(vectors, near) if n[p][1] == i]
                if own:
                    book[i] = [sum(c) // len(own) for c in zip(*own)]
    near = assign()
    errors = [sum(gap for gap, _ in n) for n in near]
    totals = {}
    for r, e in zip(fine, errors):
        totals[r[2]] = totals.get(r[2], 0) + e
    found = [
        (r[0], "".join(f"{i:02x}" for _, i in n), e, totals[r[2]])
        for r, n, e in zip(fine, near, errors)
    ]
    return sorted(found, key=repr), books


def check(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], SCHEMA)
    found, codebooks = V.vector_codes(df)
    expected, books = brute(df.select("vec_id", "embedding", "label").collect())
    assert codebooks.entries.tolist() == books
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    return found


def vectors(n, width, seed=1):
    rnd = random.Random(seed)
    return [
        (rnd.randrange(10 * n), [rnd.gauss(0, 0.1) for _ in range(width)], rnd.choice([None, 1, 1, 2]))
        for _ in range(n)
    ]


def test_random_vectors(spark):
    check(spark, vectors(600, 8))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(20, 6) + [
        (1, None, 1),
        (2, [0.1, None], 1),
        (3, [nan], 1),
        (4, [0.5, inf], 2),
        (5, [-inf, 0.5], 2),
        (6, [], None),
        (7, [0.25, -0.25, 1.0], 3),
        (7, [0.25, -0.25, 1.0], 3),
        (7, [0.5], None),
        (None, [1.0, 2.0, -3.0, 0.0001, -0.0001], 3),
        (None, [1.0, 2.0], 3),
    ]
    check(spark, rows)


def test_fewer_rows_than_entries_and_hot_vector(spark):
    check(spark, [(i, [0.5, -0.5, 0.25, 0.125], i % 3) for i in range(300)])
    check(spark, [(9, [0.5, -0.5, 0.25, 0.125], None)])


def test_empty_table(spark):
    found, codebooks = V.vector_codes(spark.createDataFrame([], SCHEMA))
    assert found.collect() == [] and codebooks.entries.size == 0


def test_batches_are_bounded(spark, monkeypatch):
    rows = spark.range(0, 20000, 1, 1).selectExpr("id", "1 AS label", "array(int(id % 50), 3) AS v")
    packs = V.pack_rows(rows, 4)
    sizes = [len(r["ids"]) for r in packs.select("ids").collect()]
    assert sum(sizes) == 20000 and max(sizes) == V.BATCH_ROWS
    # each batch holds a dictionary for each dimension, padding included
    assert {tuple(r["sizes"]) for r in packs.select("sizes").collect()} == {(50, 1, 1, 1)}


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(1, [1e9], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="a component is"):
        V.vector_codes(df)[0].collect()
