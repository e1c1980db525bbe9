"""CSV files that are read in splits."""

import csv
import random

import pytest

from corpusflow.sources import csv_records, exports


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, rows):
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([("ID", "Title", "Content"), *rows])


def random_rows(n, seed):
    rnd = random.Random(seed)
    parts = ["word", "\n", '"', '""', ",", "a,b", "Grüße", " ", "\n\n", "x" * 400, '"\n"', "\r", "\\"]
    return [
        (i, "T" + "".join(rnd.choices(parts, k=rnd.randrange(4))), "C" + "".join(rnd.choices(parts, k=rnd.randrange(9))))
        for i in range(n)
    ]


def test_one_file_many_tasks(spark, tmp_path, small_splits):
    rows = random_rows(300, 1)
    write(tmp_path / "one.csv", rows)
    records = csv_records.csv_records(spark, str(tmp_path))
    assert csv_records._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    read = exports.read_articles(spark, str(tmp_path), "csv")
    assert sorted((r["ID"], r["Title"], r["Content"]) for r in read.collect()) == rows
    assert records.filter("header").count() == 1 and records.count() == 301


def test_many_files(spark, tmp_path, small_splits):
    expected = []
    for k in range(5):
        rows = [(1000 * k + i, t, c) for i, t, c in random_rows(40 * k, k)]
        write(tmp_path / f"{k}.csv", rows)
        expected += rows
    read = exports.read_articles(spark, str(tmp_path), "csv")
    assert sorted((r["ID"], r["Title"], r["Content"]) for r in read.collect()) == expected


def test_same_as_spark_reads_whole_files(spark, tmp_path, small_splits):
    """Records over several splits, empty and short lines, an open quote at the end."""
    long = "line\n" * 500
    (tmp_path / "a.csv").write_text(
        f'ID,Title,Content\n1,"{long}","{long}"\n\n2,short\n3,,\n4,"","q ""x"" q"\n5,a,"never\nended'
    )
    read = exports.read_articles(spark, str(tmp_path), "csv")
    whole = spark.read.options(**exports._CSV, multiLine=True).csv(str(tmp_path))
    wanted = sorted((int(r["ID"]), r["Title"], r["Content"]) for r in whole.collect() if r["ID"] != "5")
    got = sorted((r["ID"], r["Title"], r["Content"]) for r in read.collect())
    assert got[:4] == wanted
    assert got[4][0] == 5


def test_header_alone(spark, tmp_path):
    write(tmp_path / "a.csv", [])
    assert exports.read_articles(spark, str(tmp_path), "csv").count() == 0
