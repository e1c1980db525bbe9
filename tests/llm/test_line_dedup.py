import random

import pytest
from cases import ODD_TEXTS

from corpusflow.llm import line_dedup


def slow(rows, min_lines, long_chars):
    """Texts without later copies, in the order of ids; rows have distinct ids."""
    seen_lines, seen_runs, gone = {}, {}, set()
    docs = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        docs[doc] = [(k, line) for k, line in enumerate(lines) if line.strip(" \t\n\r\x0b\x0c")]
    for doc in sorted(docs):
        entries = docs[doc]
        for at, (raw, line) in enumerate(entries):
            if seen_lines.setdefault(line, (doc, raw)) != (doc, raw) and len(line) >= long_chars:
                gone.add((doc, raw))
            run = tuple(content for _, content in entries[at : at + min_lines])
            if len(run) == min_lines and seen_runs.setdefault(run, (doc, raw)) != (doc, raw):
                gone |= {(doc, r) for r, _ in entries[at : at + min_lines]}
    return {
        doc: text
        if not any(d == doc for d, _ in gone)
        else "\n".join(x for k, x in enumerate(text.split("\n")) if (doc, k) not in gone)
        for doc, text in rows
    }


@pytest.mark.parametrize("min_lines", [1, 2, 3, 4, 5, 7])
def test_random_documents(spark, min_lines):
    rng = random.Random(min_lines)
    rows = [
        (doc, "\n".join(rng.choice(["a", "b", "c", "", " ", "a longer line"]) for _ in range(rng.randint(0, 25))))
        for doc in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.drop_repeated_lines(docs, min_lines=min_lines, long_line_chars=10)
    assert dict(map(tuple, found.collect())) == slow(rows, min_lines, 10)


def test_first_copies_are_reported(spark):
    rows = [(1, "w\nx\ny\nz"), (2, "q\nx\ny\nz\nr"), (3, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.drop_repeated_lines(docs, min_lines=3, report=("n", "of"))
    assert {r["doc_id"]: (r["text"], r["n"], r["of"]) for r in found.collect()} == {
        1: ("w\nx\ny\nz", 0, []),
        2: ("q\nr", 3, [1]),
        3: ("v", 0, []),
    }


def test_odd_documents(odd):
    found = line_dedup.drop_repeated_lines(odd, min_lines=1, long_line_chars=1)
    assert found.columns == odd.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr)
    assert len(rows) == len(ODD_TEXTS)
    # the row that is listed twice keeps its first line, both times; its copy loses all
    assert [t for i, t in rows if i == 5] == ["same text here"] * 2
    assert sorted(t for i, t in rows if i == 6) == ["", "another text with the same id"]
    assert (1, None) in rows and (2, "") in rows and (3, " \t\n\n ") in rows


def test_no_documents(none):
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_a_line_of_a_third_of_all_rows(spark):
    rows = [(k, "hot line\n" + (f"own {k}" if k % 3 else "other hot line")) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.drop_repeated_lines(docs, min_lines=2)
    assert dict(map(tuple, found.collect())) == slow(rows, 2, line_dedup.LONG_LINE_CHARS)


def test_no_python(odd, plan):
    assert "Python" not in plan(line_dedup.drop_repeated_lines(odd))
