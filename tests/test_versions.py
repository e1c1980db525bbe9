"""The store's log of versions, its consolidated part, statistics and term counts."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import features, stats
from corpusflow.plans import update
from corpusflow.sources import files, log, store

WORDS = ("rate", "bank", "market", "growth", "price")


def rows(spark, n, first=1, words=WORDS, **extra):
    data = [
        (
            first + i,
            f"T{first + i}",
            [None, "Business", "World"][i % 3],
            f"2024-01-{1 + i % 28:02d} 10:00:00",
            " ".join(words[: 1 + i % len(words)]),
            [None, "short"][i % 2],
        )
        for i in range(n)
    ]
    names = ("ID bigint", "Title string", "Section string", "`Published Date` string")
    schema = ", ".join((*names, "processed_text string", "summary string"))
    df = spark.createDataFrame(data, schema)
    return df.withColumns({name: F.lit(v) for name, v in extra.items()})


def ids(df):
    return sorted(r["ID"] for r in df.select("ID").collect())


def as_rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def publish(spark, path, topic):
    labels = store.read_store(spark, path, topics=False).select("ID", topic.alias("Topic"))
    metadata = spark.createDataFrame([("x",)], "phase string")
    store.write_topics(labels, metadata, path)


def test_one_of_several_writers_creates_a_file(spark, tmp_path):
    target = str(tmp_path / "log" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.create_new(spark, target, f"text {k}"), range(16)))
    assert won.count(True) == 1
    assert files.read_text(spark, target) == f"text {won.index(True)}"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_concurrent_appends_are_all_kept(spark, path):
    update.append_batch(spark, rows(spark, 5), path, "first")
    new = [rows(spark, 4, 100 * k).drop("ID") for k in range(1, 5)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: update.append_batch(spark, new[k], path, f"b{k}"), range(4)))
    assert ids(store.read_store(spark, path)) == list(range(1, 22))


def test_concurrent_first_batches_have_different_ids(spark, path):
    new = [rows(spark, 3), rows(spark, 3)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: update.append_batch(spark, new[k], path, f"b{k}"), range(2)))
    assert ids(store.read_store(spark, path)) == [1, 2, 3, 4, 5, 6]


def test_commits_are_worked_out_anew(spark, path):
    """A commit that finds its number taken sees what was committed in between."""
    seen = []

    def change(state):
        seen.append(state.version)
        if len(seen) == 1:
            store.reserve(spark, path, "other", 10)
        return [{"do": "reserve", "label": "mine", "start": state.next_id, "count": 5}]

    state, _ = log.commit(spark, path, change)
    assert seen == [0, 1]
    assert state.ranges == {"other": [0, 10], "mine": [10, 5]}


def test_log_is_compacted_and_reads_any_version(spark, path, monkeypatch):
    monkeypatch.setattr(log, "STATE_EVERY", 3)
    for k in range(8):
        store.reserve(spark, path, f"b{k}", 2)
    names = files.child_names(spark, f"{path}/log")
    assert [n for n in names if n.endswith(".state")] == ["000000000003.state", "000000000006.state"]
    for version in range(9):
        state = log.read(spark, path, version)
        assert (state.version, state.next_id) == (version, 2 * version)
    with pytest.raises(ValueError, match="no version 9"):
        log.read(spark, path, 9)


def test_old_versions_stay_readable(spark, path):
    store.write_batch(rows(spark, 3), path, "a")
    before = store.current_version(spark, path)
    store.write_batch(rows(spark, 2, 10), path, "b")
    store.write_batch(rows(spark, 1, 20), path, "a")  # replaces
    assert ids(store.read_store(spark, path)) == [10, 11, 20]
    assert ids(store.read_store(spark, path, version=before)) == [1, 2, 3]
    store.consolidate(spark, path, 2)
    now = store.current_version(spark, path)
    assert ids(store.read_store(spark, path, version=before)) == [1, 2, 3]
    gone = store.vacuum(spark, path, now)
    assert gone and all("write=" in folder for folder in gone)
    assert ids(store.read_store(spark, path)) == [10, 11, 20]


@pytest.mark.parametrize("label", ["", "a/b", "a b", "a=b"])
def test_labels_are_names(spark, path, label):
    with pytest.raises(ValueError, match="label"):
        store.write_batch(rows(spark, 1), path, label)


def test_consolidated_articles_meet_their_topics_without_moving(spark, path, plan):
    store.write_batch(rows(spark, 40), path, "a")
    store.write_batch(rows(spark, 20, 100, extra="x"), path, "b")
    publish(spark, path, (F.col("ID") % 3).cast("int"))
    store.consolidate(spark, path, 4)
    read = store.read_store(spark, path)
    assert "Exchange" not in plan(read) and "Bucketed: true" in plan(read)
    assert {(r["ID"], r["Topic"]) for r in read.collect()} == {
        (i, i % 3) for i in [*range(1, 41), *range(100, 120)]
    }
    assert read.columns == [
        "ID", "Title", "Section", "Published Date", "processed_text", "summary", "extra", "Topic"
    ]
    # a second run is laid out like the articles at once
    publish(spark, path, (F.col("ID") % 2).cast("int"))
    read = store.read_store(spark, path)
    assert "Exchange" not in plan(read)
    assert all(r["Topic"] == r["ID"] % 2 for r in read.collect())
    # later rows come from beside the base: only they move, and lack a label
    store.write_batch(rows(spark, 5, 200), path, "c")
    read = store.read_store(spark, path)
    assert plan(read).count("Exchange hashpartitioning") == 1
    assert read.filter("Topic IS NULL").count() == 5 and read.count() == 65
    # and go into the next base
    store.consolidate(spark, path, 3)
    read = store.read_store(spark, path)
    assert "Exchange" not in plan(read)
    assert {(r["ID"], r["Topic"]) for r in read.collect() if r["ID"] < 200} == {
        (i, i % 2) for i in [*range(1, 41), *range(100, 120)]
    }
    assert spark.catalog.listTables() == []


def test_consolidated_batches_are_not_replaced(spark, path):
    store.write_batch(rows(spark, 3), path, "a")
    store.consolidate(spark, path, 2)
    with pytest.raises(log.Conflict, match="already consolidated"):
        store.write_batch(rows(spark, 1), path, "a")
    assert ids(store.read_store(spark, path)) == [1, 2, 3]


def test_a_batch_replaced_meanwhile_stops_consolidation(spark, path, monkeypatch):
    store.write_batch(rows(spark, 3), path, "a")
    real = store.buckets.write_bucketed

    def interrupted(*args):
        store.write_batch(rows(spark, 1, 50), path, "a")
        real(*args)

    monkeypatch.setattr(store.buckets, "write_bucketed", interrupted)
    with pytest.raises(log.Conflict, match="meanwhile"):
        store.consolidate(spark, path, 2)
    assert ids(store.read_store(spark, path)) == [50]


def test_summaries_of_consolidated_articles_are_filled(spark, path):
    store.write_batch(rows(spark, 4, Content="Banks cut the main rate today in a surprise."), path, "a")
    store.consolidate(spark, path, 2)
    store.write_batch(rows(spark, 2, 10, Content="Markets rose after the cut of the rate."), path, "b")
    assert store.read_store(spark, path).filter("summary IS NULL").count() == 3
    assert update.refresh_summaries(spark, path)
    filled = store.read_store(spark, path)
    assert filled.filter("summary IS NULL OR summary = ''").count() == 0
    assert filled.filter("summary = 'short'").count() == 3
    assert update.stored_status(spark, path).first()["has_summaries"]


def check_statistics(spark, path):
    everything = store.read_store(spark, path)
    got = update.stored_stats(spark, path).drop("last_updated")
    assert as_rows(got) == as_rows(stats.store_stats(everything).drop("last_updated"))
    assert as_rows(update.stored_status(spark, path)) == as_rows(stats.store_status(everything))
    assert as_rows(update.stored_counts(spark, path)) == as_rows(stats.store_counts(everything))


def test_statistics_need_no_article(spark, path, plan):
    store.write_batch(rows(spark, 10), path, "a")
    check_statistics(spark, path)
    both = rows(spark, 6, 20, batch="b").unionByName(rows(spark, 7, 40, batch="c"))
    store.write_batches(both, path)
    check_statistics(spark, path)
    store.write_batch(rows(spark, 3, 60), path, "b")  # one of two batches of a write
    check_statistics(spark, path)
    publish(spark, path, (F.col("ID") % 3).cast("int"))
    check_statistics(spark, path)
    store.consolidate(spark, path, 2)
    check_statistics(spark, path)
    store.write_batch(rows(spark, 4, 80), path, "d")
    publish(spark, path, (F.col("ID") % 2).cast("int"))
    check_statistics(spark, path)
    for df in (update.stored_stats, update.stored_status, update.stored_counts):
        assert "/articles" not in plan(df(spark, path)) and "/base" not in plan(df(spark, path))


def check_terms(spark, path):
    texts = store.read_store(spark, path, topics=False)
    whole = features.term_document_counts(texts, "processed_text")
    assert as_rows(store.term_counts(spark, path)) == as_rows(whole)


def test_term_counts_add_up(spark, path, monkeypatch):
    store.write_batch(rows(spark, 10), path, "a")
    check_terms(spark, path)
    read = []
    real = features.term_document_counts

    def counted(df, text, by=()):
        if by:
            read.append(ids(df))
        return real(df, text, by)

    monkeypatch.setattr(features, "term_document_counts", counted)
    store.write_batch(rows(spark, 4, 20, words=("new", "words")), path, "b")
    store.write_batch(rows(spark, 2, 30, words=("none",)).withColumn("processed_text", F.lit(None).cast("string")), path, "c")
    check_terms(spark, path)
    assert read == [[20, 21, 22, 23, 30, 31]]  # new articles only
    store.write_batch(rows(spark, 3, 40, words=("other",)), path, "b")  # replaced
    check_terms(spark, path)
    assert read[1:] == [[40, 41, 42]]
    store.consolidate(spark, path, 2)
    check_terms(spark, path)
    store.write_batch(rows(spark, 3, 50), path, "d")
    check_terms(spark, path)
    assert read[2:] == [[50, 51, 52]]


def test_consolidation_without_term_counts(spark, path):
    store.write_batch(rows(spark, 6), path, "a")
    store.consolidate(spark, path, 2)
    store.write_batch(rows(spark, 2, 10), path, "b")
    check_terms(spark, path)


def test_state_is_plain_json(spark, path):
    store.write_batch(rows(spark, 1), path, "a")
    text = files.read_text(spark, f"{path}/log/000000000001.json")
    assert [a["do"] for a in json.loads(text)] == ["batch"]
