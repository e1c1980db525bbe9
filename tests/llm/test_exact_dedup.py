"""Exact duplicates against a plain grouping."""

import hashlib
import re
from collections import defaultdict

from corpusflow.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(normal.encode()).hexdigest()].append(doc_id)
    expected = []
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known, default=None)
        expected += [(i, keep, len(ids), digest) for i in ids]
    return sorted(expected, key=repr), len(groups)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = exact_dedup.exact_duplicates(docs, **options).collect()
    plain = sorted(((r[0], r[1], r[2], r[4]) for r in found), key=repr)
    expected, groups = brute(rows)
    assert plain == expected
    kept = [r for r in found if r["kept"]]
    assert len(kept) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(spark, rows)
    found = exact_dedup.exact_duplicates(odd)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found.count() == len(rows)


def test_white_space_and_case(spark):
    texts = ["a b", "a  b", "a\t\n\x0bb", " a b", "a b ", "A b", "a b", "a\x1cb", "", None, "   "]
    check(spark, list(enumerate(texts)))


def test_hot_text_and_long_texts(spark):
    rows = [(i, "the same") for i in range(700)] + [(i, f"text {i // 2}") for i in range(700, 2000)]
    rows += [(5000 + i, "long " * 60000 + str(i // 3)) for i in range(6)]
    check(spark, rows)


def test_empty_table(none):
    assert exact_dedup.exact_duplicates(none).collect() == []


def test_filter_in_slices(spark):
    """More rows than one filter may hold: slices of the hash range, the same result."""
    rows = [(i, f"text {i % 15000}") for i in range(20000)]
    check(spark, rows, max_filter_bytes=4096)


def test_only_possible_repeats_pass(spark):
    """Of rows that differ few pass a filter, and no repeated row is ever lost."""
    docs = spark.range(20000).selectExpr("id", "id AS row", "sha2(string(id div 2 * int(id < 4000) + id * int(id >= 4000)), 256) AS digest")
    alone, again = exact_dedup.bloom_pass(docs, "first pass")
    assert alone.count() + again.count() == 20000
    assert again.filter("id < 4000").count() == 4000
    assert again.filter("id >= 4000").count() < 0.2 * 16000
    second, last = exact_dedup.bloom_pass(again, "second pass")
    assert last.filter("id < 4000").count() == 4000
    assert last.filter("id >= 4000").count() < 0.04 * 16000
    assert second.count() + last.count() == again.count()


def test_no_python_in_the_plan(spark, odd, plan):
    text = plan(exact_dedup.exact_duplicates(odd))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
