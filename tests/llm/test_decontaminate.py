import random

import numpy as np
from cases import ODD_TEXTS

from corpusflow.llm import decontaminate


def slow_align(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for k, y in enumerate(b):
            step = 2 if x == y and x else -1
            row.append(max(0, above[k] + step, above[k + 1] - 1, row[k] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 25)) for _ in range(2))
        assert decontaminate.align(a, b) == slow_align(a.tolist(), b.tolist())


def words(rng, count):
    return [rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(count)]


def edited(rng, item):
    """About one word in seven is replaced, left out or doubled."""
    out = []
    for word in item:
        out += rng.choice([[word]] * 18 + [["new"], [], [word, word]])
    return out


def test_copies_and_edited_copies(spark):
    rng = random.Random(1)
    items = [words(rng, rng.randint(15, 60)) for _ in range(30)]
    rows, expected = [], set()
    for doc in range(200):
        text = words(rng, 150)
        if doc % 4 == 0:
            item = doc // 4 % 30
            copy = edited(rng, items[item]) if doc % 8 else items[item]
            text = text[:70] + copy + text[70:]
            expected.add((doc, item))
        rows.append((doc, " ".join(text).capitalize() + "."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(
        [(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string"
    )
    for block_words in (200_000, 300):
        found = decontaminate.with_matches(docs, benchmark, block_words=block_words)
        got = {(r["doc_id"], m["item"]) for r in found.collect() for m in r["matches"]}
        assert got == expected


def test_an_item_in_most_documents_is_still_found(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.createDataFrame([(k, f"{k} {item}") for k in range(50)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.with_matches(docs, benchmark).collect()
    assert all([m["score"] for m in r["matches"]] == [1.0] for r in found)


def test_an_edited_passage_that_is_copied_is_found_in_every_copy(spark):
    item = [f"w{k}" for k in range(30)]
    passage = [f"new{k}" if k in (3, 9, 15, 21, 27) else word for k, word in enumerate(item)]
    half = item[:15]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for text, score in ((passage, 0.75), (half, 0.5)):
        for copies, exact in ((1, 0), (2, 0), (5, 1), (50, 1)):
            texts = [text] * copies + [item] * exact
            rows = [(k, f"before {k} " + " ".join(words)) for k, words in enumerate(texts)]
            docs = spark.createDataFrame(rows + [(99, "w4 w5 w6 alone")], "doc_id long, text string")
            found = decontaminate.with_matches(docs, benchmark).orderBy("doc_id").collect()
            scores = [[m["score"] for m in r["matches"]] for r in found]
            assert scores == [[score]] * copies + [[1.0]] * exact + [[]], (score, copies, exact)


def test_odd_documents_and_items(spark, odd):
    benchmark = spark.createDataFrame(
        [(1, None), (2, ""), (3, "two words"), (None, "another text with the same id"), (5, "x y z")],
        "item_id long, text string",
    )
    found = decontaminate.with_matches(odd, benchmark, matches_col="ids")
    assert found.columns == [c for c in odd.columns if c != "ids"] + ["ids"]
    rows = found.collect()
    assert len(rows) == len(ODD_TEXTS)
    hits = [(r["doc_id"], m["item"]) for r in rows for m in r["ids"]]
    assert hits == [(6, None)]


def test_no_documents_or_items(spark, none, odd):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.with_matches(none, items).count() == 0
    assert {len(r["matches"]) for r in decontaminate.with_matches(odd, items).collect()} == {0}
    some = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert decontaminate.with_matches(none, some).count() == 0
