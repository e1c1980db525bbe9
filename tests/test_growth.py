"""How much work jobs do as their input grows."""

import json
import os
import time
import tracemalloc

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import graph, kmeans, search, windows
from corpusflow.plans import store_queries, topic_queries, update
from corpusflow.sources import scratch, store
from corpusflow.streaming import ingest


def shuffle_files(spark):
    """Names of the shuffle files on disk."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = manager.getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {name for name in names if name.startswith("shuffle_")}


def test_a_round_of_kmeans_is_one_stage(spark):
    vectors = np.random.default_rng(3).normal(size=(300, 3))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "row bigint, v array<double>")
    points = kmeans._packed(df).persist()
    points.count()
    runs = [kmeans.Run(k, 1, vectors[at : at + k].copy()) for at, k in ((0, 2), (9, 2), (5, 3))]
    context = spark.sparkContext
    context.setJobGroup("a-round", "")
    try:
        found = kmeans._pass(points, runs)
    finally:
        context.setJobGroup("other", "")
        points.unpersist()
    tracker = context.statusTracker()
    jobs = tracker.getJobIdsForGroup("a-round")
    assert [len(tracker.getJobInfo(j).stageIds) for j in jobs] == [1]
    for run, (centres, cost, step) in zip(runs, found):
        gaps = ((vectors[:, None] - run.centres) ** 2).sum(axis=2)
        near = gaps.argmin(axis=1)
        wanted = np.array([vectors[near == c].mean(axis=0) for c in range(run.k)])
        assert np.allclose(centres, wanted)
        assert cost == pytest.approx(gaps.min(axis=1).sum())
        assert step == pytest.approx(np.sqrt(((wanted - run.centres) ** 2).sum(axis=1)).max())


def test_a_pass_of_kmeans_holds_few_distances():
    rng = np.random.default_rng(5)
    points, centres = rng.normal(size=(kmeans.PACK, 10)), rng.normal(size=(4 * 3 + 30 * 7, 10))
    points[100:110] = points[0]
    centres[13] = centres[12]  # the first of two equal centres takes the points of both
    blocks = [(3, 4), (7, 30)]
    tracemalloc.start()
    counts, totals, costs = kmeans._sums([(points,)], centres, blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < points.shape[0] * len(centres) * 8 / 2  # not one distance of each pair
    gaps = ((points[:, None] - centres) ** 2).sum(axis=2)
    at = 0
    for run, size in enumerate([3] * 4 + [7] * 30):
        near = gaps[:, at : at + size].argmin(axis=1)
        assert counts[at : at + size].tolist() == np.bincount(near, minlength=size).tolist()
        wanted = [points[near == c].sum(axis=0) for c in range(size)]
        assert np.allclose(totals[at : at + size], wanted)
        assert costs[run] == pytest.approx(gaps[:, at : at + size].min(axis=1).sum())
        at += size


def test_cards_are_not_dealt_out_by_topic(spark, plan):
    df = spark.range(100).selectExpr(
        "id AS ID", "'t' AS Title", "cast(id % 2 AS int) AS Topic", "'c' AS Content", "'s' AS summary"
    )
    names = spark.createDataFrame([(0, "a"), (1, "b")], "topic int, name string").repartition(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (search.search_cards(df, names), search.filter_topic_group(df, names, "a")):
            assert "BroadcastHashJoin" in plan(found)
            assert "hashpartitioning(Topic" not in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def counted(spark, df):
    """``df`` whose text is made by a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        calls.add(1)
        return f"First words of article number{i} here. " * 3 + f"theme{i % 3} " * 4

    return df.withColumn("processed_text", text("ID")), calls


def test_texts_of_charts_are_worked_out_once(spark, tmp_path):
    df = spark.range(30).selectExpr("id AS ID", "cast(id % 2 AS int) AS Topic", "'s' AS Section")
    df, calls = counted(spark, df)
    keywords = spark.createDataFrame([(0, 0, "a", 1.0)], "topic int, rank int, term string, weight double")
    paths = update.write_chart_tables(update.chart_tables(df, keywords, 2), str(tmp_path / "charts"))
    assert spark.read.parquet(paths["topic_scatter"]).count() == 30
    assert calls.value == 30


def test_queries_of_terms_read_the_documents_once(spark, sf_dir):
    found = topic_queries.processed(spark, sf_dir)
    assert not any("documents" in name for name in found.inputFiles())
    same = topic_queries.texts(spark, sf_dir)
    assert sorted(found.collect()) == sorted(same.collect())


def test_a_micro_batch_is_worked_out_once(spark, tmp_path, monkeypatch, plan):
    article = {
        "id": "1", "webTitle": "t", "webUrl": "u", "sectionName": "s",
        "webPublicationDate": "2024-01-01T00:00:00Z", "fields": {"byline": "b", "body": "c d"},
    }
    landing = tmp_path / "landing"
    landing.mkdir()
    response = {"response": {"status": "ok", "total": 2, "results": [article, article]}}
    (landing / "one.json").write_text(json.dumps(response))
    seen = []
    monkeypatch.setattr(
        ingest, "append_batch", lambda spark, rows, *_, **__: seen.append((plan(rows), rows.count()))
    )
    paths = (str(landing), str(tmp_path / "store"), str(tmp_path / "check"))
    ingest.stream_ingest(spark, *paths, multi_line=False, unique_titles=True).awaitTermination()
    [(read, count)] = seen
    assert count == 1
    assert "FileScan parquet" in read  # else each job works it out again


def test_new_articles_of_a_store_are_worked_out_once(spark, tmp_path):
    df, calls = counted(spark, spark.range(20).selectExpr("id AS ID", "'t' AS Title"))
    df = df.withColumn("Content", F.col("processed_text"))
    path = str(tmp_path / "store")
    for made in (20, 40):
        update.update_store(spark, df, path, reprocess_topics=False)
        assert calls.value == made


def test_a_round_of_spread_ranks_sorts_nothing(spark, plan):
    state = spark.createDataFrame(
        [(1, 0, 2.0, 0.0, [0.4, 0.5], [0.1, 0.2])],
        "ID long, node int, n double, alone double, xs array<double>, zs array<double>",
    )
    links = [(1, 0, 0, 1.0), (1, 0, 0, None)]
    shares = spark.createDataFrame(links, "ID long, node int, to int, share double")
    found = graph._round(state, shares, "ID")
    assert "SortAggregate" not in plan(found)
    base = (1 - graph.DAMPING) / 2
    [row] = found.collect()
    assert row["xs"] == pytest.approx([0.4, 0.5, base + 0.5 * graph.DAMPING])
    assert row["zs"] == pytest.approx([0.1, 0.2, base])


def test_kept_rows_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = scratch.kept(spark.range(1000).repartition(7, "id"), "rows")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert rows.agg(F.sum("id")).first()[0] == 499500


def test_rows_of_any_columns_are_fixed(spark):
    rows = spark.range(3).select("id", F.lit(None).alias("nothing"), F.array(F.lit(None)).alias("none"))
    assert rows.schema["nothing"].dataType.typeName() == "void"
    assert sorted(scratch.fixed(rows, "rows").collect()) == sorted(rows.collect())


def test_numbered_rows_move_once(spark, plan):
    """They do not move again to meet the first number of their partition."""
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit("text").alias("text"))
    # As for more rows than Spark would broadcast by itself.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = windows.assign_ids(rows, 0, ["k"])
        assert "Exchange hashpartitioning" not in plan(numbered)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [tuple(r) for r in numbered.orderBy("ID").collect()] == [(i + 1, i, "text") for i in range(500)]


def _landed(folder, files):
    """JSON files of three articles each, modified one after another."""
    folder.mkdir()
    body = "Markets rose sharply today after the central bank cut its main interest rate. "
    for k in range(files):
        results = [
            {
                "webTitle": f"Title {k}",
                "webUrl": f"u{k}-{i}",
                "sectionName": "Business",
                "webPublicationDate": "2024-01-15T10:30:00Z",
                "fields": {"body": body * 20},
            }
            for i in range(3)
        ]
        file = folder / f"{k}.json"
        file.write_text(json.dumps({"response": {"results": results}}))
        os.utime(file, (k, k))
    return file.stat().st_size


def test_a_stream_holds_raw_rows_of_one_micro_batch(spark, tmp_path, monkeypatch):
    landing, path = tmp_path / "landing", str(tmp_path / "store")
    size = _landed(landing, 4)
    seen, folders = [], []
    append, scratch_path = ingest.append_batch, scratch.scratch_path

    def spy(session, rows, *args, **options):
        seen.append((rows.columns, [f for f in folders if os.path.exists(f)]))
        return append(session, rows, *args, **options)

    def made(session, name):
        folders.append(scratch_path(session, name).removeprefix("file:"))
        return folders[-1]

    monkeypatch.setattr(ingest, "append_batch", spy)
    monkeypatch.setattr(scratch, "scratch_path", made)
    ingest.stream_ingest(
        spark, str(landing), path, str(tmp_path / "state"), bytes_at_once=2 * size, delete_read=True
    ).awaitTermination()
    # Two micro-batches, each with its own rows alone and no texts or tokens made of them.
    assert [len(there) for _, there in seen] == [1, 1]
    assert all("cleaned_text" not in columns for columns, _ in seen)
    assert folders and not any(os.path.exists(folder) for folder in folders)
    until = time.time() + 20
    while len(list(landing.glob("*.json"))) > 2 and time.time() < until:
        time.sleep(0.1)
    assert len(list(landing.glob("*.json"))) <= 2  # the first micro-batch's went
    rows = store.read_store(spark, path)
    assert rows.columns[-3:] == ["summary", "summary_length", "compression_ratio"]
    assert sorted(r["ID"] for r in rows.collect()) == list(range(1, 13))
    assert rows.filter("size(tokens) > 50 AND summary <> ''").count() == 12


def test_a_stored_batch_is_packed(spark, tmp_path):
    """Words of an array are written once a file, also if they take more than 1 MB."""
    words = spark.range(200_000).select((F.col("id") % 120_000).cast("string").alias("w"))
    words = words.groupBy().agg(F.collect_list(F.concat(F.lit("word number "), "w")).alias("tokens"))
    store.write_batch(words.withColumn("ID", F.lit(1)), str(tmp_path / "store"), "one")
    (file,) = (tmp_path / "store").glob("articles/*/*/*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    column = next(group.column(i) for i in range(2) if "tokens" in group.column(i).path_in_schema)
    assert column.compression == "ZSTD"
    assert "PLAIN" not in column.encodings


@pytest.mark.parametrize("query", ["stream_articles", "stream_titles"])
def test_landed_responses_of_a_query_are_packed(spark, sf_dir, monkeypatch, query):
    found = []

    class Stop(Exception):
        pass

    def ingest_(spark, landing, *_, **options):
        found.append((os.listdir(landing.removeprefix("file:")), options))
        raise Stop

    monkeypatch.setattr(store_queries, "stream_ingest", ingest_)
    with pytest.raises(Stop):
        store_queries.QUERIES[query](spark, sf_dir)
    names, options = found[0]
    names = [name for name in names if name.startswith("part-")]
    assert all(name.endswith(".txt.gz") for name in names)
    assert options["delete_read"]
    if query == "stream_titles":  # several micro-batches of several files each
        assert 1 < options["files_at_once"] < len(names)
    else:
        assert options["bytes_at_once"]


def test_responses_move_once_to_their_files(spark, sf_dir, plan):
    texts = store_queries._response_texts(spark, sf_dir, 3)
    assert plan(texts).count("Exchange") == 1
    assert texts.rdd.getNumPartitions() == 3
    alike = store_queries._response_texts(spark, sf_dir)
    assert sorted(texts.collect()) == sorted(alike.collect())


def _sentence_nodes(spark):
    sets = [[f"w{(i * j) % 17}" for j in range(1, 5)] for i in range(40)]
    return spark.createDataFrame([(1, sets), (2, sets[:9])], "ID long, sets array<array<string>>")


def test_both_sides_of_the_edge_join_move_once(spark, plan):
    edges = graph.joined_edges(_sentence_nodes(spark), "ID")
    rows = {tuple(r) for r in edges.collect()}
    assert "ReusedExchange" in plan(edges)  # of tokens that are one block
    blocks = {tuple(r) for r in graph.joined_edges(_sentence_nodes(spark), "ID", 4).collect()}
    assert rows and rows == blocks


def test_edges_move_once_to_be_shares(spark, plan):
    links = [(1, 0, 1, 0.5), (1, 0, 2, 0.25), (2, 0, 1, 0.2)]
    edges = spark.createDataFrame(links, "ID long, src int, dst int, weight double")
    shares = graph._shares(edges, "ID", 3)
    assert plan(shares).count("Exchange") == 1
    found = sorted((r[:3], r["share"]) for r in shares.collect() if r["share"] is not None)
    third = pytest.approx(1 / 3)
    assert found == [
        ((1, 0, 1), pytest.approx(2 / 3)),
        ((1, 0, 2), third),
        ((1, 1, 0), 1.0),
        ((1, 2, 0), 1.0),
        ((2, 0, 1), 1.0),
        ((2, 1, 0), 1.0),
    ]
    own = sorted(r[:3] for r in shares.collect() if r["share"] is None)
    assert own == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 0, 0), (2, 1, 1)]


def test_rounds_of_spread_ranks_leave_no_shuffle_files(spark, monkeypatch):
    before, made = shuffle_files(spark), []
    scratch_path = scratch.scratch_path
    monkeypatch.setattr(
        scratch, "scratch_path", lambda *a: made.append(scratch_path(*a).removeprefix("file:")) or made[-1]
    )
    ranked = graph.spread_ranks(_sentence_nodes(spark), "ID")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    there = [os.path.basename(path).split("-")[0] for path in made if os.path.exists(path)]
    assert set(there) <= {"last"}  # neither the edges nor what they were found by
    assert ranked.count() == 2
