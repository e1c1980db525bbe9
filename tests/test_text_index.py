"""Search by the trigrams of files."""

import re

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import search
from corpusflow.sources import store, text_index


@pytest.mark.parametrize(
    "pattern, runs",
    [
        ("rate cut", ["rate cut"]),
        ("Rate.*CUT", ["rate", "cut"]),
        ("tion(s|al)? the", ["tion", " the"]),
        ("colou?r", ["colo"]),
        ("abcd*e", ["abc"]),
        ("abc+def", ["abc", "def"]),
        ("ab{2}cde", ["cde"]),
        (r"one\.two\sthree", ["one", "two", "three"]),
        ("[abc]def[^]x]ghi", ["def", "ghi"]),
        ("(abc(def))ghi", ["ghi"]),
        ("grüne wiese", ["gr", "ne wiese"]),
        ("ab", []),
        ("abc|def", []),
        ("(?x) abc", []),
        (r"\x41bcd", []),
        (r"\p{L}abc", []),
        (r"\Qabc\E", []),
        ("abc(", []),
        ("abc\\", []),
        ("", []),
    ],
)
def test_required_trigrams(pattern, runs):
    expected = {r[k : k + 3] for r in runs for k in range(len(r) - 2)}
    assert text_index.required_trigrams(pattern) == expected


TEXTS = [
    ("Rate cut", "The bank CUT its rate."),
    ("Straße", "Grüne Wiese; Kelſey İstanbul"),
    (None, "colour and color"),
    ("ab", None),
    ("", ""),
    (None, None),
    ("x" * 5000, "quiet " * 2000),
    ("ABC 123 def", "one.two three"),
]
PATTERNS = ["rate cut", "RATE", "kelsey", "istanbul", "colou?r", "iet q", "123 d", "zzz", "straße", "one.two", "ab", "(", ""]


def test_search_equals_a_scan_and_skips_files(spark, tmp_path):
    path = str(tmp_path / "a store")
    rows = [(i, *t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "ID bigint, Title string, Content string")
    store.write_batch(df.repartition(len(rows)), path, "a")
    store.write_batch(df.withColumn("ID", F.col("ID") + 100), path, "b")
    store.consolidate(spark, path, 16)
    store.write_batch(df.withColumn("ID", F.col("ID") + 200), path, "c")
    everything = store.read_store(spark, path, topics=False)
    for pattern in PATTERNS:
        if pattern == "(":
            continue
        wanted = sorted(r["ID"] for r in search.search_articles(everything, pattern).collect())
        assert sorted(r["ID"] for r in store.search_store(spark, path, pattern).collect()) == wanted
    found, count = store.matching_files(spark, path, "kelsey")
    assert 0 < len(found) < count / 2
    assert store.matching_files(spark, path, "zzz") == ([], count)
    # the plan reads these files alone
    read = store.search_store(spark, path, "kelsey")
    assert sorted(f.split("/")[-1] for f in read.inputFiles()) == sorted(f.split("/")[-1] for f in found)


def test_replaced_batches_are_not_found(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "old words", "")], "ID bigint, Title string, Content string")
    store.write_batch(df, path, "a")
    assert store.search_store(spark, path, "words").count() == 1
    store.write_batch(df.withColumn("Title", F.lit("other")), path, "a")
    assert store.search_store(spark, path, "words").count() == 0
    assert [r["Title"] for r in store.search_store(spark, path, "oth").collect()] == ["other"]


def test_index_reads_no_row_in_python(spark, tmp_path, plan):
    spark.range(5).select(F.col("id").cast("string").alias("Title")).write.parquet(str(tmp_path / "p"))
    index = text_index.file_index(spark.read.parquet(str(tmp_path / "p")), ["Title"])
    assert not re.search("Python|Arrow|Pandas", plan(index))
    # a file without any trigram has an empty bitmap
    rows = index.collect()
    assert len({r["file"] for r in rows}) == 5 and not any(any(r["bits"]) for r in rows)
