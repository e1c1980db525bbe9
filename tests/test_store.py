import json

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import clean, search, stats, topics, windows
from corpusflow.operators.joins import update_by_key
from corpusflow.plans import store_queries, update
from corpusflow.sources import exports, responses, store
from corpusflow.sources.scratch import checkpoint_root
from corpusflow.streaming.ingest import stream_ingest

TEXT = (
    "Markets rose sharply today after the central bank cut its main interest rate. "
    "The central bank said that the rate cut would support growth across markets. "
    "Analysts expect another cut of the interest rate before the end of the year."
)


def article(**changes):
    base = {
        "id": "x",
        "webTitle": "Title",
        "webUrl": "https://example.com/x",
        "sectionName": "Business",
        "webPublicationDate": "2024-01-15T10:30:00Z",
        "fields": {"body": f"<p>{TEXT}</p>", "byline": "A Writer"},
    }
    return {**base, **changes}


def response(*articles):
    return json.dumps({"response": {"status": "ok", "results": list(articles)}})


def flatten(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return responses.flatten_response(responses.parse_responses(df))


def test_flatten(spark):
    no_id = article()
    del no_id["id"]
    no_fields = article()
    del no_fields["fields"]
    text = response(
        article(),
        no_id,
        no_fields,
        article(fields={}),
        article(webTitle="", fields={"byline": "", "body": ""}),
    )
    rows = flatten(spark, text).orderBy("ID").collect()
    assert [r["ID"] for r in rows] == [0, 1, 2, 3, 4]
    assert [r["Author"] for r in rows] == ["A Writer", "A Writer"] + ["Unknown"] * 3
    assert [r["Content"] for r in rows] == [TEXT, TEXT, "", "", ""]
    assert rows[4]["Title"] == ""
    assert rows[0]["Published Date"] == "2024-01-15 10:30:00"


@pytest.mark.parametrize(
    "text",
    [
        "{}",
        '{"response": {}}',
        '{"response": {"results": null}}',
        '{"response": {"results": "none"}}',
        '{"response": {"results": {"a": 1}}}',
        '{"response": {"results": []}}',
        "not json",
    ],
)
def test_no_results(spark, text):
    assert flatten(spark, text).count() == 0


@pytest.mark.parametrize("name", ["webTitle", "webUrl", "sectionName", "webPublicationDate"])
def test_required_fields(spark, name):
    broken = article()
    del broken[name]
    with pytest.raises(Exception, match=f"article without {name}"):
        flatten(spark, response(broken)).collect()


def test_read_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(json.loads(response(article())), indent=2))
    (tmp_path / "two.json").write_text("broken {")
    read = responses.read_article_json(spark, str(tmp_path))
    assert responses.flatten_response(read).count() == 1


def rows(spark, n, with_id=True, **extra):
    data = [(i + 1, f"T{i}", "Test", TEXT) for i in range(n)]
    df = spark.createDataFrame(data, "ID bigint, Title string, Section string, Content string")
    df = df.withColumns({name: F.lit(v) for name, v in extra.items()})
    return df if with_id else df.drop("ID")


def test_append_numbers_new_rows(spark):
    merged = store.append_articles(rows(spark, 2), rows(spark, 2, with_id=False, extra=1))
    assert sorted(r["ID"] for r in merged.collect()) == [1, 2, 3, 4]
    assert merged.filter("extra IS NULL").count() == 2
    fresh = store.append_articles(None, rows(spark, 3, False))
    assert sorted(r["ID"] for r in fresh.collect()) == [1, 2, 3]
    kept = store.append_articles(None, rows(spark, 1).withColumn("ID", F.lit(7)))
    assert kept.first()["ID"] == 7


def test_assign_ids_with_one_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, "same").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 3).alias("v"),
    )
    done = windows.assign_ids(df, 10, ["k"]).cache()
    ids = [r["ID"] for r in done.orderBy("ID").select("ID").collect()]
    assert ids == list(range(11, 3011))
    keys = [r["k"] for r in done.orderBy("ID").collect()]
    assert keys == sorted(keys)
    assert windows.assign_ids(df.limit(0), 10, ["k"]).count() == 0


def test_dedup_keeps_first_and_cuts_before_the_shuffle(spark, plan):
    df = spark.createDataFrame(
        [(3, "a"), (1, "a"), (2, None), (4, None), (5, "A")], "ID int, Title string"
    )
    kept = windows.dedup_by_title(df)
    assert sorted(r["ID"] for r in kept.collect()) == [1, 2, 5]
    assert "partial_min" in plan(kept)


def test_update_by_key_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "ID int, s string, n int")
    new = spark.createDataFrame(
        [(1, "x", 1), (1, None, 2), (9, "z", 1)], "ID int, s string, at int"
    )
    got = {r["ID"]: r["s"] for r in update_by_key(df, new, ["s"], "at").collect()}
    assert got == {1: None, 2: "b"}


def test_csv_round_trip(spark, tmp_path):
    data = [(1, 'He said "no",\nthen left. ', ["a", "b"], 3), (2, None, [], None)]
    df = spark.createDataFrame(
        data, "ID bigint, Content string, tokens array<string>, word_count int"
    )
    exports.write_articles(df, str(tmp_path / "csv"), "csv")
    read = exports.read_articles(spark, str(tmp_path / "csv"), "csv").orderBy("ID")
    assert [tuple(r) for r in read.collect()] == [tuple(r) for r in df.collect()]
    (tmp_path / "foreign.csv").write_text("Topic,tokens\n3.0,\"['x', 'y']\"\n")
    row = exports.read_articles(spark, str(tmp_path / "foreign.csv"), "csv").first()
    assert (row["Topic"], row["tokens"]) == (3, ["x", "y"])


def test_store_updates(spark, tmp_path):
    path = str(tmp_path / "store")
    assert update.refresh_summaries(spark, path) is False
    assert not update.update_store(spark, rows(spark, 2), path)
    stored = store.read_store(spark, path)
    assert stored.filter("length(summary) > 0").count() == 2
    new = rows(spark, 1, with_id=False, processed_text="market rate")
    assert not update.update_store(spark, new, path, reprocess_topics=False, backup=True)
    assert sorted(r["ID"] for r in store.read_store(spark, path).collect()) == [1, 2, 3]
    backups = [p.name for p in tmp_path.iterdir() if ".backup_" in p.name]
    assert len(backups) == 1
    assert spark.read.parquet(str(tmp_path / backups[0])).count() == 2
    # the same label replaces its batch
    for _ in range(2):
        update.append_batch(spark, rows(spark, 2, with_id=False), path, "again")
    assert sorted(r["ID"] for r in store.read_store(spark, path).collect()) == [1, 2, 3, 4, 5]


def test_refresh_touches_open_batches_only(spark, tmp_path):
    path = str(tmp_path / "store")
    store.write_batch(rows(spark, 1, summary="mine", summary_length=1), path, "full")
    open_rows = rows(spark, 1, summary=" ").withColumn("ID", F.lit(2).cast("bigint"))
    store.write_batch(open_rows, path, "open")
    full = sorted((tmp_path / "store/articles").glob("write=*/batch=full/*"))
    before = {p: p.stat().st_mtime_ns for p in full}
    assert update.refresh_summaries(spark, path) is True
    got = {r["ID"]: r["summary"] for r in store.read_store(spark, path).collect()}
    assert got[1] == "mine"
    assert len(got[2].split()) > 5
    assert sorted((tmp_path / "store/articles").glob("write=*/batch=full/*")) == full
    assert before == {p: p.stat().st_mtime_ns for p in full}


def test_topics_of_store(spark, tmp_path):
    path = str(tmp_path / "store")
    data = [
        (i, f"T{i}", "Test", f"red{i % 2} blue{i % 2} green{i % 2} tail{i % 2}", "s")
        for i in range(1, 21)
    ]
    df = spark.createDataFrame(
        data, "ID bigint, Title string, Section string, processed_text string, summary string"
    )
    assert update.update_store(spark, df, path, k_values=(2,))
    stored = store.read_store(spark, path)
    assert stored.groupBy("Topic").count().count() == 2
    target = str(tmp_path / "out")
    paths = update.export_downloads(spark, path, target)
    assert exports.read_articles(spark, paths["articles"], "csv").count() == 20
    numbers = spark.read.json(paths["statistics"]).first()
    assert numbers["total_articles"] == 20
    assert numbers["sections"]["Test"] == 20
    metadata = exports.read_topic_metadata(spark, paths["metadata"]).first()
    assert metadata["parameters"]["best_k"] == 2


def test_process_batch(spark):
    row = update.process_batch(rows(spark, 1)).first()
    assert row["cleaned_text"].startswith("markets rose sharply")
    assert row["token_count"] > row["token_count_no_stop"] > 0
    assert row["summary"] and row["compression_ratio"] <= 1


def test_store_statistics(spark):
    df = rows(spark, 3).withColumn("Topic", F.when(F.col("ID") == 1, 0).otherwise(1))
    df = df.withColumn("Published Date", F.concat(F.lit("2024-01-0"), F.col("ID")))
    row = stats.store_stats(df).first()
    assert (row["total_articles"], row["has_topics"], row["has_summaries"]) == (3, True, False)
    assert (row["earliest"], row["latest"]) == ("2024-01-01", "2024-01-03")
    counts = {(r["kind"], r["name"]): r["articles"] for r in stats.store_counts(df).collect()}
    assert counts == {("section", "Test"): 3, ("topic", "0"): 1, ("topic", "1"): 2}


def test_search(spark):
    df = spark.createDataFrame(
        [(1, "Élan vital", "x"), (2, None, "An élan"), (3, "No", None)],
        "ID int, Title string, Content string",
    )
    assert [r["ID"] for r in search.search_articles(df, "ÉLAN").orderBy("ID").collect()] == [1, 2]
    assert search.search_articles(df, "").count() == 3
    assert search.search_articles(df, "^n.$").count() == 1


def test_filters_reach_the_scan(spark, sf_dir, plan):
    from corpusflow.sources.tables import articles

    df = search.filter_section(articles(spark, sf_dir), "src1").select("ID")
    assert "EqualTo(source,src1)" in plan(df)
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan(df)


def test_stream(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()

    def ingest():
        checkpoint = str(tmp_path / "checkpoint")
        stream_ingest(spark, str(landing), path, checkpoint).awaitTermination()
        return store.read_store(spark, path).orderBy("ID").collect()

    (landing / "a.json").write_text(response(article(), article(webTitle="Two")))
    assert [r["ID"] for r in ingest()] == [1, 2]
    (landing / "b.json").write_text(response(article(webTitle="Three")))
    rows_now = ingest()
    assert [r["ID"] for r in rows_now] == [1, 2, 3]
    assert rows_now[2]["Title"] == "Three"
    assert rows_now[2]["summary"]
    assert rows_now[2]["processed_text"].startswith("market rose sharp")


def test_a_stream_stores_each_title_once(spark, tmp_path):
    """In one file, in a later file and after a restart; the first article stays."""
    landing, path = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()

    def ingest(**options):
        checkpoint = str(tmp_path / "checkpoint")
        stream_ingest(
            spark, str(landing), path, checkpoint, unique_titles=True, **options
        ).awaitTermination()
        return sorted((r["Title"], r["Url"]) for r in store.read_store(spark, path).collect())

    (landing / "a.json").write_text(
        response(article(webUrl="u1"), article(webUrl="u2"), article(webTitle="Two", webUrl="u3"))
    )
    assert ingest() == [("Title", "u1"), ("Two", "u3")]
    (landing / "b.json").write_text(response(article(webUrl="u4"), article(webTitle="title", webUrl="u5")))
    (landing / "c.json").write_text(response(article(webTitle="Three", webUrl="u6")))
    expected = [("Three", "u6"), ("Title", "u1"), ("Two", "u3"), ("title", "u5")]
    assert ingest(files_at_once=1) == expected
    assert ingest() == expected


def test_titles_once_by_the_rule_of_a_batch(spark, tmp_path):
    """One micro-batch with many rows of a title: the row that the batch rule keeps."""
    landing, path = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    many = [article(webTitle=f"T{i % 3}", webUrl=f"u{i:03d}") for i in range(200)]
    (landing / "a.json").write_text(response(*many))
    raw = responses.flatten_response(responses.read_article_json(spark, str(landing)))
    wanted = sorted(r["Url"] for r in windows.dedup_by_title(raw).collect())
    stream_ingest(
        spark, str(landing), path, str(tmp_path / "checkpoint"), unique_titles=True
    ).awaitTermination()
    assert sorted(r["Url"] for r in store.read_store(spark, path).collect()) == wanted


def test_streams_with_own_checkpoints_share_a_store(spark, tmp_path):
    path = str(tmp_path / "store")
    for name in ("one", "two"):
        landing = tmp_path / name
        landing.mkdir()
        (landing / "a.json").write_text(response(article(webTitle=name), article(webTitle=name)))
        stream_ingest(spark, str(landing), path, str(tmp_path / f"{name}-state")).awaitTermination()
    stored = store.read_store(spark, path).orderBy("ID").collect()
    assert [r["Title"] for r in stored] == ["one", "one", "two", "two"]
    assert [r["ID"] for r in stored] == [1, 2, 3, 4]


def test_half_written_batches_are_not_read(spark, tmp_path):
    path = str(tmp_path / "store")
    store.write_batch(rows(spark, 3), path, "whole")
    half = rows(spark, 2).withColumn("batch", F.lit("half"))
    half.write.partitionBy("batch").parquet(f"{path}/articles/write=0")
    assert store.read_store(spark, path).count() == 3
    assert store.largest_id(spark, path) == 3


def test_many_batches_are_refreshed_at_once(spark, tmp_path):
    path = str(tmp_path / "store")
    for k in range(4):
        summary = "mine" if k == 2 else " "
        store.write_batch(rows(spark, 2, summary=summary), path, f"b{k}")
    assert update.refresh_summaries(spark, path) is True
    found = store.read_batches(spark, path).collect()
    assert len(found) == 8
    assert {r["batch"] for r in found if r["summary"] == "mine"} == {"b2"}
    assert all(len(r["summary"].split()) > 5 for r in found if r["batch"] != "b2")


def test_articles_of_many_responses_get_their_own_ids(spark):
    texts = [response(article(webUrl=f"u{k}a"), article(webUrl=f"u{k}b")) for k in range(3)]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = responses.parse_responses(df)
    assert sorted(r["ID"] for r in responses.flatten_response(parsed).collect()) == [0, 0, 0, 1, 1, 1]
    numbered = responses.flatten_responses(parsed).orderBy("ID").collect()
    assert [r["ID"] for r in numbered] == [1, 2, 3, 4, 5, 6]
    assert [r["Url"] for r in numbered] == ["u0a", "u0b", "u1a", "u1b", "u2a", "u2b"]


def test_statistics_have_no_limit(spark, tmp_path):
    df = spark.range(12_000).select(
        F.concat(F.lit("s"), F.col("id")).alias("Section"), F.lit(None).cast("int").alias("Topic")
    )
    exports.export_stats_json(df, str(tmp_path / "s"), 2, 0.5)
    found = json.loads(next((tmp_path / "s").glob("part-*")).read_text())
    assert len(found["sections"]) == 12_000
    assert found["topic_distribution"] == {}


def test_checkpoint_folder_is_the_sessions_own(spark):
    root = checkpoint_root(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        assert root == configured
    assert root.removeprefix("file:") in spark.sparkContext.getCheckpointDir()


def test_cards(spark):
    df = spark.createDataFrame(
        [(1, "one two", 0, "c"), (2, None, 4, "c"), (3, " ", None, "c")],
        "ID int, summary string, summary_length int, Content string",
    ).withColumns({n: F.lit("t") for n in ("Title", "Section", "Author", "Url", "Published Date")})
    got = {r["ID"]: (r["summary_words"], r["body"]) for r in search.article_cards(df).collect()}
    assert got == {1: (2, "one two"), 2: (4, "c"), 3: (None, " ")}
    lengths = {r["ID"]: r["summary_length"] for r in search.fill_summary_length(df).collect()}
    assert lengths == {1: 2, 2: 4, 3: None}
    assert clean.nlp_articles(df).columns == df.columns


def test_update_store_query_chooses_among_all_k(spark, sf_dir, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    monkeypatch.setattr(store_queries, "scratch_path", lambda *_: path)
    store_queries.update_store(spark, sf_dir)
    run = store.read_run_metadata(spark, path).first()
    assert tuple(run["parameters"]["k_values_tested"]) == topics.K_FOR_UPDATE
