import random
import re

import pytest
from cases import ODD_TEXTS
from pyspark.sql import functions as F

from corpusflow.llm import pii


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def digits_of(text):
    return re.sub("[^0-9]", "", text)


RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(part) <= 255 for part in m.split(".")),
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 13 <= len(digits_of(m)) <= 19 and luhn(digits_of(m)),
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits_of(m)) <= 15),
}


def slow(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}"
        for kind, (shape, valid) in RULES.items()
        for m in re.finditer(shape, text or "")
        if valid(m.group())
    )


def found(docs, base_only=True):
    return sorted(
        pii.personal_data(docs).select("doc_id", pii.span_list(base_only=base_only)).collect(),
        key=repr,
    )


def test_base_spans(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("a1299..@@+- ()é%4\U0001f600", k=rng.randint(1, 120))) for _ in range(400)]
    texts += ["a@b.c_d@e.f 1.2.3.4.5.6.7.8 0001.00000255.3.4 256.1.1.1", "4111-1111 1111 1111 4111111111111112"]
    texts += ["9" * 60000, "a" * 5000, "a" * 60000 + "@b.c", "1." * 20000, "+1" + " " * 50000 + "2345678 (90)"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in found(docs)] == sorted(((i, slow(t)) for i, t in rows), key=repr)


def test_odd_documents(odd):
    assert [tuple(r) for r in found(odd)] == sorted(((i, slow(t)) for i, t in ODD_TEXTS), key=repr)


def test_no_documents(none):
    assert found(none) == []


def corpus(spark, misleading=0):
    rows = [f"some words Tel. +1 (20{k % 10}) 555-{1000 + k} and more" for k in range(40)]
    rows += [f"write to E-Mail bob{k}@example.com today" for k in range(20)]
    rows += [f"other Tel. 555-20{10 + k} end, E-Mail al{k} (at) example (dot) com" for k in range(10)]
    rows += [f"a part with code 77-8{k:02}-99 here" for k in range(10)]
    rows += [f"some words Tel. 10.0.0.{k} and more" for k in range(misleading)]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_good_patterns_find_more(spark):
    spans = {i: s for i, s in found(corpus(spark), base_only=False)}
    base = {i: s for i, s in found(corpus(spark), base_only=True)}
    for k in range(60, 70):
        assert base[k] == ""
        assert [s.split(":")[0] for s in spans[k].split(",")] == ["email", "phone"]
    assert all(spans[k] == base[k] for k in range(80) if k not in range(60, 70))


def test_a_pattern_before_other_kinds_finds_nothing(spark):
    spans = {i: s for i, s in found(corpus(spark, misleading=20), base_only=False)}
    assert all("phone" not in spans[k] for k in range(60, 70))


def test_confidence_of_patterns(spark):
    rows = [("p", f"v{k}", "phone", []) for k in range(19)] + [("p", "x", "ip", [])]
    rows += [("p", "new", None, ["phone", "card"]), ("q", "new", None, ["phone"])]
    rows += [("q", f"w{k}", "phone", []) for k in range(7)]
    edges = spark.createDataFrame(rows, "pattern string, value string, known string, kinds array<string>")
    good, values = pii.bootstrap(edges)
    assert [(r["pattern"], r["kind"]) for r in good.collect()][:1] == [("p", "phone")]
    assert [tuple(r) for r in values.collect()] == [("new", "phone")]
    # the value found by the first pattern is the second one's eighth
    assert {r["pattern"] for r in good.collect()} == {"p", "q"}


def test_loose_occurrences_of_seed_values(spark):
    rows = [f"Tel. +1 (212) 555-01{k} here" for k in range(10, 22)]
    rows += [f"Card 4111 1111 1111 {n} here" for n in [str(k) for k in range(1000, 1200) if luhn(f"411111111111{k}")][:9]]
    rows += [f"Mail bob{k}@example.com now" for k in range(9)]
    known = len(rows)
    rows += ["Tel. 1 (212) 555-0110 here", "Card " + rows[12][5:24].replace(" ", ".") + " here"]
    rows += ["Mail bob3 (at) example [dot] com now", "code 1 (212) 555-0111 here"]
    spans = dict(found(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), base_only=False))
    assert all(spans[k].count(":") == 2 for k in range(known))
    assert [spans[k] for k in range(known, len(rows))] == ["phone:5:21", "card:5:24", "email:5:32", ""]


def test_seed_values_vote_for_the_patterns_they_are_met_behind(spark):
    rows = [("p", f"v{k}", "phone", []) for k in range(9)]
    rows += [("q", f"v{k}", None, ["phone", "card"]) for k in range(9)] + [("q", "new", None, ["phone", "card"])]
    edges = spark.createDataFrame(rows, "pattern string, value string, known string, kinds array<string>")
    good, values = pii.bootstrap(edges)
    assert {(r["pattern"], r["kind"], r["known"]) for r in good.collect()} == {("p", "phone", 9), ("q", "phone", 10)}
    assert [tuple(r) for r in values.collect()] == [("new", "phone")]


def chain(spark, length):
    """Patterns that share eight values with the next one each; the first has seeds."""
    rows = [("p0", f"s{k}", "phone", []) for k in range(8)]
    for i in range(length):
        for pattern in (f"p{i}", f"p{i + 1}"):
            rows += [(pattern, f"v{i}-{k}", None, ["phone"]) for k in range(8)]
    return spark.createDataFrame(rows, "pattern string, value string, known string, kinds array<string>")


def test_long_chains_of_patterns_are_followed_to_their_end(spark):
    good, values = pii.bootstrap(chain(spark, 6))
    assert {r["pattern"] for r in good.collect()} == {f"p{i}" for i in range(7)}
    assert values.count() == 48
    with pytest.raises(RuntimeError, match="no end"):
        pii.bootstrap(chain(spark, 6), max_rounds=4)


def test_texts_are_read_once_without_python(odd, plan):
    scanned = pii.scan(odd, "doc_id", "text")
    assert "Exchange" not in plan(scanned) and "Python" not in plan(scanned)
    assert scanned.filter(F.size("hits") > 0).count() > 0
