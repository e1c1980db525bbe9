import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from cases import ODD_TEXTS

from corpusflow.llm import quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


COLUMNS = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def measured(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality.ledger(docs).orderBy("doc_id").collect()
    return [tuple(r[c] for c in COLUMNS) for r in rows]


def test_measures(spark):
    texts = [t for _, t in ODD_TEXTS if t is None or len(t) < 1000]
    texts += ["a b c d e f g h " * 3, "a b c d e f g h i " * 2 + "x", "z\nz\n\n\nz\ny", "word " * 300]
    assert measured(spark, texts) == [slow(t) for t in texts]


@settings(max_examples=3, deadline=None)
@given(texts=st.lists(st.text("ab \n#\t", max_size=80), max_size=40))
def test_measures_of_random_texts(spark, texts):
    assert measured(spark, [*texts, "a"]) == [slow(t) for t in [*texts, "a"]]


def test_columns_and_rows_stay(odd):
    found = quality.with_ledger(odd, ledger_col="bits")
    assert found.columns == [c for c in odd.columns if c != "bits"] + ["bits"]
    assert found.count() == len(ODD_TEXTS)


def test_no_documents(none):
    assert quality.ledger(none).count() == 0
    assert {r["failed"] for r in quality.ablation(quality.ledger(none)).collect()} == {0}


def test_base_policy_is_the_two_rules(spark):
    good = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(1, "few"), (2, good), (3, "a b c d e f g h " * 9)], "doc_id long, text string")
    rows = quality.ledger(docs).select("doc_id", quality.passes("failed_rules", "base")).collect()
    assert sorted(map(tuple, rows)) == [(1, False), (2, True), (3, False)]


@pytest.mark.parametrize("policy", sorted(quality.POLICIES))
def test_ablation(spark, policy):
    enforced = quality.mask(quality.POLICIES[policy])
    bits = [k % (1 << len(quality.RULES)) for k in range(0, 600, 7)]
    ledger = spark.createDataFrame([(b,) for b in bits], "failed_rules long")
    for row in quality.ablation(ledger, policy).collect():
        bit = 1 << list(quality.RULES).index(row["rule"])
        assert row["failed"] == sum(bool(b & bit) for b in bits)
        assert row["failed_alone"] == sum(b & enforced == bit for b in bits)
        assert row["kept_without"] == sum(not b & enforced & ~bit for b in bits)


def test_one_pass_without_shuffle(odd, plan):
    text = plan(quality.with_ledger(odd))
    assert "Exchange" not in text and "Python" not in text
