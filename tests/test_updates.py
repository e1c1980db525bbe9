"""Changes of stored articles that write only the files which hold them."""

import pytest
from pyspark.sql import functions as F
from test_versions import as_rows, check_statistics, check_terms, ids, publish, rows

from corpusflow.sources import files, log, store, updates


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def changes(spark, new, name="Title", kind="string"):
    return spark.createDataFrame(list(new.items()), f"ID bigint, `{name}` {kind}")


def spread(spark, path, label, n, first=1, parts=10):
    """A batch of several files, with a range of IDs each."""
    texts = rows(spark, n, first).withColumn("Content", F.concat(F.lit("about T"), "ID"))
    store.write_batch(texts.repartitionByRange(parts, "ID"), path, label)


def titles(spark, path, version=None):
    found = store.read_store(spark, path, topics=False, version=version).select("ID", "Title")
    return {r["ID"]: r["Title"] for r in found.collect()}


def data_files(path, kind):
    return {p: p.stat().st_mtime_ns for p in path.glob(f"store/{kind}/**/part-*.parquet")}


def test_only_files_with_changed_ids_are_written(spark, path, tmp_path):
    spread(spark, path, "a", 100)
    spread(spark, path, "b", 100, 1001)
    before, old = store.current_version(spark, path), data_files(tmp_path, "articles")
    new = {i: f"New {i}" for i in (3, 4, 5, 98, 1050)}
    replaced = updates.update_articles(changes(spark, new), path)
    assert len(replaced) == 3
    now = data_files(tmp_path, "articles")
    assert {p: now[p] for p in old} == old  # nothing is changed in place
    added = [str(p) for p in now.keys() - old.keys()]
    held = spark.read.schema("ID bigint").parquet(*replaced_paths(path, replaced))
    assert ids(spark.read.schema("ID bigint").parquet(*added)) == ids(held)
    assert held.count() == 30
    expected = {i: f"T{i}" for i in [*range(1, 101), *range(1001, 1101)]}
    assert titles(spark, path) == {**expected, **new}
    assert titles(spark, path, before) == expected
    check_statistics(spark, path)
    # a later change of the same and of other articles starts from the newest files
    more = {4: None, 50: "Other"}
    assert len(updates.update_articles(changes(spark, more), path)) == 2
    assert titles(spark, path) == {**expected, **new, **more}
    check_statistics(spark, path)


def replaced_paths(path, names):
    return [f"{path}/{name}" for name in names]


def test_changes_of_merged_articles(spark, path, tmp_path, plan):
    spread(spark, path, "a", 64)
    publish(spark, path, (F.col("ID") % 3).cast("int"))
    store.consolidate(spark, path, 8)
    spread(spark, path, "late", 20, 101, 4)
    before, old = store.current_version(spark, path), data_files(tmp_path, "base")
    new = {7: "Seven", 110: "Late"}
    replaced = updates.update_articles(changes(spark, new), path)
    assert sorted(name.split("/")[0] for name in replaced) == ["articles", "base"]
    now = data_files(tmp_path, "base")
    assert {p: now[p] for p in old} == old and len(now) == len(old) + 1
    expected = {i: f"T{i}" for i in [*range(1, 65), *range(101, 121)]}
    assert titles(spark, path) == {**expected, **new}
    assert titles(spark, path, before) == expected
    check_statistics(spark, path)
    # labels still meet the merged articles in their buckets; only later rows move
    read = store.read_store(spark, path)
    assert plan(read).count("Exchange hashpartitioning") == 1
    assert all(r["Topic"] == r["ID"] % 3 for r in read.filter("ID < 100").collect())
    updates.update_articles(changes(spark, {7: "Again", 8: "Eight"}), path)
    store.consolidate(spark, path, 4)
    assert titles(spark, path) == {**expected, **new, 7: "Again", 8: "Eight"}
    assert spark.catalog.listTables() == []


@pytest.mark.parametrize("merged", [False, True])
def test_terms_and_search_follow_changes(spark, path, merged):
    spread(spark, path, "a", 40, parts=5)
    spread(spark, path, "b", 10, 101, 2)
    if merged:
        store.consolidate(spark, path, 4)
    check_terms(spark, path)
    assert ids(store.search_store(spark, path, "about T1[0-9]")) == [*range(10, 20), *range(101, 111)]
    updates.update_articles(changes(spark, {12: "Gone", 30: "about T19 too"}, "Content"), path)
    found = [10, 11, *range(13, 20), *range(101, 111)]
    assert ids(store.search_store(spark, path, "about T1[0-9]")) == sorted([*found, 30])
    check_terms(spark, path)
    words = {5: "entirely new words", 102: None}
    updates.update_articles(changes(spark, words, "processed_text"), path)
    check_terms(spark, path)
    check_statistics(spark, path)


def test_terms_are_kept_if_their_text_is(spark, path, monkeypatch):
    spread(spark, path, "a", 20, parts=4)
    store.term_counts(spark, path)
    updates.update_articles(changes(spark, {3: "New"}), path)

    def none(*args):
        raise AssertionError("texts were read")

    monkeypatch.setattr(store.features, "term_document_counts", none)
    assert store.term_counts(spark, path).count() == 5


def test_new_columns_and_nulls(spark, path):
    spread(spark, path, "a", 10, parts=2)
    updates.update_articles(changes(spark, {2: 0.5}, "score", "double"), path)
    found = {r["ID"]: (r["score"], r["Title"]) for r in store.read_store(spark, path).collect()}
    assert found == {i: (0.5 if i == 2 else None, f"T{i}") for i in range(1, 11)}


def test_all_rows_of_an_id_change(spark, path):
    twice = rows(spark, 4).unionByName(rows(spark, 1, 2)).repartition(5)
    store.write_batch(twice, path, "a")
    updates.update_articles(changes(spark, {2: "Both"}), path)
    found = store.read_store(spark, path).collect()
    assert sorted(r["Title"] for r in found) == ["Both", "Both", "T1", "T3", "T4"]


def test_many_changes_are_joined(spark, path, monkeypatch):
    monkeypatch.setattr(updates, "SENT_CHARS", 0)
    monkeypatch.setattr(updates, "INTERVALS", 3)
    spread(spark, path, "a", 60)
    spread(spark, path, "b", 30, 201, 3)
    new = {i: f"N{i}" for i in (1, 2, 59, 60, 225)}
    assert len(updates.update_articles(changes(spark, new), path)) == 3
    expected = {i: f"T{i}" for i in [*range(1, 61), *range(201, 231)]}
    assert titles(spark, path) == {**expected, **new}
    # ranges of the new files are narrow: a further change finds one of them
    assert len(updates.update_articles(changes(spark, {1: "x"}), path)) == 1


@pytest.mark.parametrize(
    ("new", "message"),
    [([(None, "x")], "null or repeated"), ([(1, "x"), (1, "y")], "null or repeated"),
     ([(1, "x"), (99, "y")], "not stored"), ([(-5, "y")], "not stored")],
)
@pytest.mark.parametrize("merged", [False, True])
def test_wrong_changes_change_nothing(spark, path, new, message, merged):
    spread(spark, path, "a", 10, parts=2)
    if merged:
        store.consolidate(spark, path, 2)
    frame = spark.createDataFrame(new, "ID bigint, Title string")
    with pytest.raises(ValueError, match=message):
        updates.update_articles(frame, path)
    assert titles(spark, path) == {i: f"T{i}" for i in range(1, 11)}


def test_nothing_to_change(spark, path):
    none = spark.createDataFrame([], "ID bigint, Title string")
    with pytest.raises(ValueError, match="no store"):
        updates.update_articles(none, path)
    spread(spark, path, "a", 10, parts=2)
    assert updates.update_articles(none, path) == []
    for bad in (none.drop("Title"), none.drop("ID"), none.withColumn("batch", F.lit("b"))):
        with pytest.raises(ValueError, match="changes need"):
            updates.update_articles(bad, path)


@pytest.mark.parametrize("merged", [False, True])
def test_a_change_meanwhile_is_a_conflict(spark, path, monkeypatch, merged):
    spread(spark, path, "a", 20, parts=4)
    if merged:
        store.consolidate(spark, path, 2)
    real = updates.log.commit

    def interrupted(spark, path, change):
        monkeypatch.setattr(updates.log, "commit", real)
        updates.update_articles(changes(spark, {2: "First"}), path)
        return real(spark, path, change)

    store.search_store(spark, path, "about")
    updates.update_articles(changes(spark, {20: "Ranges are known"}), path)
    monkeypatch.setattr(updates.log, "commit", interrupted)
    with pytest.raises(log.Conflict, match="meanwhile"):
        updates.update_articles(changes(spark, {2: "Second"}), path)
    assert titles(spark, path)[2] == "First"
    assert len(ids(store.read_store(spark, path))) == 20


@pytest.mark.parametrize("merged", [False, True])
def test_replaced_files_are_deleted_when_unused(spark, path, tmp_path, merged):
    spread(spark, path, "a", 40, parts=8)
    if merged:
        store.consolidate(spark, path, 8)
    before = store.current_version(spark, path)
    replaced = updates.update_articles(changes(spark, {2: "New"}), path)
    assert not set(replaced) & set(store.vacuum(spark, path, before))
    assert titles(spark, path, before)[2] == "T2"
    gone = store.vacuum(spark, path, store.current_version(spark, path))
    assert set(replaced) <= set(gone)
    assert not any(files.exists(spark, f"{path}/{name}") for name in replaced)
    assert titles(spark, path) == {i: "New" if i == 2 else f"T{i}" for i in range(1, 41)}
    assert as_rows(store.search_store(spark, path, "New").select("ID")) == [(2,)]
